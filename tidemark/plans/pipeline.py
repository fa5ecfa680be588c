"""The five phases, from raw messages to identified ports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas
from tidemark.config import Config
from tidemark.operators import cells, clusters, enrich, matching, stops
from tidemark.sinks.export import path_join, write_geojson, write_table
from tidemark.sources.messages import read_messages
from tidemark.sources.portdb import load_port_db, require

FILES = {1: "stops.parquet", 2: "h3_counts.parquet", 3: "harbour_clusters.parquet", 4: "harbours_enriched.parquet", 5: "harbours.parquet"}


def ports(messages: DataFrame, cities: DataFrame, countries: DataFrame, cfg: Config, existing: DataFrame | None = None) -> DataFrame:
    """All phases as one plan."""
    found = stops.extract_stops(messages, cfg.stops)
    hot = cells.count_cells(found, cfg.cells)
    made = clusters.form_clusters(hot, cfg.clusters, cfg.cells)
    return matching.identify(enrich.enrich(made, cities, countries, cfg.enrich, cfg.cells), existing, cfg.match)


def _interim(spark: SparkSession, cfg: Config, phase: int) -> DataFrame:
    path = require(spark, path_join(cfg.data["interim_dir"], FILES[phase]), f"phase{phase}")
    kind = (schemas.STOPS, schemas.CELLS, schemas.CLUSTERS, schemas.ENRICHED)[phase - 1]
    return spark.read.schema(kind.replace("array<string>", "ARRAY<STRING>")).parquet(path)


def run_phase1(spark: SparkSession, cfg: Config) -> str:
    path = path_join(cfg.data["interim_dir"], FILES[1])
    # With a schema in the settings, files whose columns are all null (and of another type) do no harm.
    raw = read_messages(spark, cfg.data["raw_glob"], cfg.stops.columns, cfg.data.get("raw_schema"))
    write_table(stops.extract_stops(raw, cfg.stops), path, schemas.STOPS, distinct="mmsi")
    return path


def run_phase2(spark: SparkSession, cfg: Config) -> str:
    path = path_join(cfg.data["interim_dir"], FILES[2])
    write_table(cells.count_cells(_interim(spark, cfg, 1), cfg.cells), path, schemas.CELLS, distinct="h3_cell")
    return path


def run_phase3(spark: SparkSession, cfg: Config) -> str:
    path = path_join(cfg.data["interim_dir"], FILES[3])
    write_table(clusters.form_clusters(_interim(spark, cfg, 2), cfg.clusters, cfg.cells), path, schemas.CLUSTERS)
    return path


def run_phase4(spark: SparkSession, cfg: Config, cities: DataFrame, countries: DataFrame) -> str:
    path = path_join(cfg.data["interim_dir"], FILES[4])
    write_table(enrich.enrich(_interim(spark, cfg, 3), cities, countries, cfg.enrich, cfg.cells), path, schemas.ENRICHED)
    return path


def run_phase5(spark: SparkSession, cfg: Config) -> tuple[str, str]:
    existing = load_port_db(spark, cfg.match.existing_db_path) if cfg.match.existing_db_path else None
    table, doc = (path_join(cfg.data["output_dir"], f"harbours.{x}") for x in ("parquet", "geojson"))
    write_table(matching.identify(_interim(spark, cfg, 4), existing, cfg.match), table, schemas.PORTS)
    write_geojson(spark.read.parquet(table), doc)
    return table, doc


def run_all(spark: SparkSession, cfg: Config, cities: DataFrame, countries: DataFrame) -> tuple[str, str]:
    run_phase1(spark, cfg)
    run_phase2(spark, cfg)
    run_phase3(spark, cfg)
    run_phase4(spark, cfg, cities, countries)
    return run_phase5(spark, cfg)
