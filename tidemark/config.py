"""Configuration: YAML, then ``SECTION__KEY`` variables, then the short variables."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields

#: Short environment variables and the settings they override.  They win over all others.
SHORT = {
    "RAW_GLOB": ("data", "raw_glob"),
    "INTERIM_DIR": ("data", "interim_dir"),
    "OUTPUT_DIR": ("data", "output_dir"),
    "EXISTING_DB": ("phase5", "existing_db_path"),
}
TRUE = frozenset({"1", "true", "yes", "on"})


@dataclass(frozen=True)
class Columns:
    """Names of the raw columns."""

    mmsi: str = "mmsi"
    timestamp: str = "timestamp"
    lat: str = "lat"
    lon: str = "lon"
    sog: str = "sog"
    nav_status: str = "nav_status"
    msg_type: str = "msg_type"
    draught: str = "draught"
    destination: str = "destination"
    ship_type: str = "ship_type"


@dataclass(frozen=True)
class StopConfig:
    moored_nav_statuses: tuple[int, ...] = (1, 5)
    sog_threshold_knots: float = 0.5
    max_gap_minutes: float = 15
    min_stop_duration_minutes: float = 30
    min_messages_per_stop: int = 3
    positional_variance_max_meters: float = 300
    mmsi_min: int = 100_000_000
    mmsi_max: int = 999_999_999
    draught_lookup_hours: float = 6
    columns: Columns = field(default_factory=Columns)


@dataclass(frozen=True)
class CellConfig:
    h3_resolution: int = 11
    min_unique_mmsi: int = 5
    draught_change_threshold_m: float = 0.3


@dataclass(frozen=True)
class ClusterConfig:
    min_cells_per_cluster: int = 1
    min_events_per_cluster: int = 5
    cluster_ring_size: int = 3


@dataclass(frozen=True)
class EnrichConfig:
    #: Accepted, and by default not applied: the gazetteer decides what is a city.
    city_min_population: int = 1000
    enforce_population: bool = False


@dataclass(frozen=True)
class MatchConfig:
    existing_db_path: str | None = None
    h3_jaccard_threshold: float = 0.3
    centroid_match_distance_meters: float = 500.0


@dataclass(frozen=True)
class Config:
    data: dict
    stops: StopConfig
    cells: CellConfig
    clusters: ClusterConfig
    enrich: EnrichConfig
    match: MatchConfig
    spark: dict = field(default_factory=dict)
    s3: dict = field(default_factory=dict)


def coerce(text: str, like):
    """``text`` as the type of ``like``; numbers that are none stay text."""
    if isinstance(like, bool):
        return text.strip().lower() in TRUE
    if isinstance(like, (list, tuple)):
        parts = [x.strip() for x in text.split(",") if x.strip()]
        return [coerce(x, like[0]) if like else x for x in parts]
    for kind in (int, float):
        if isinstance(like, kind):
            try:
                return kind(text)
            except ValueError:
                return text
    return text


def overridden(raw: dict, env: dict[str, str]) -> dict:
    out = {k: dict(v) if isinstance(v, dict) else v for k, v in raw.items()}
    for name, value in env.items():
        section, found, key = name.partition("__")
        section, key = section.lower(), key.lower()
        if found and section in out and isinstance(out[section], dict):
            out[section][key] = coerce(value, out[section].get(key))
    for name, (section, key) in SHORT.items():
        if env.get(name):
            out.setdefault(section, {})[key] = env[name]
    return out


def _made(kind, values: dict, **more):
    """A dataclass from the known keys, coerced by field type even where YAML had no value."""
    base = kind()
    known = {}
    for f in fields(kind):
        if f.name in values and values[f.name] is not None:
            v, like = values[f.name], getattr(base, f.name)
            v = coerce(v, like) if isinstance(v, str) and like is not None else v
            known[f.name] = tuple(v) if isinstance(like, tuple) else v
    return kind(**(known | more))


def from_dict(raw: dict) -> Config:
    get = lambda k: raw.get(k) or {}
    clusters = dict(get("phase3"))
    if "min_cells_per_harbour" in clusters:
        clusters.setdefault("min_cells_per_cluster", clusters["min_cells_per_harbour"])
    return Config(
        data={"raw_glob": "data/raw/**/*.parquet", "interim_dir": "data/interim", "output_dir": "data/output"} | get("data"),
        stops=_made(StopConfig, get("phase1"), columns=_made(Columns, get("columns"))),
        cells=_made(CellConfig, get("phase2")),
        clusters=_made(ClusterConfig, clusters),
        enrich=_made(EnrichConfig, get("phase4")),
        match=_made(MatchConfig, get("phase5")),
        spark=get("spark"),
        s3=get("s3"),
    )


def load_config(path: str | None = None, env: dict[str, str] | None = None, dotenv: str | None = ".env") -> Config:
    """Read YAML and the environment.  A ``.env`` file fills in variables that are not set."""
    import yaml

    env = dict(os.environ) if env is None else dict(env)
    if dotenv and os.path.exists(dotenv):
        with open(dotenv) as f:
            for line in f:
                key, found, value = line.strip().partition("=")
                if found and not key.startswith("#"):
                    env.setdefault(key.strip(), value.strip().strip("\"'"))
    raw = {}
    if path:
        with open(path) as f:
            raw = yaml.safe_load(f) or {}
    return from_dict(overridden(raw, env))


def s3_options(s3: dict, env: dict[str, str] | None = None) -> dict[str, str]:
    """Hadoop S3A settings.  Environment credentials win over the file's."""
    env = os.environ if env is None else env
    key = env.get("AWS_ACCESS_KEY_ID") or s3.get("access_key_id") or ""
    secret = env.get("AWS_SECRET_ACCESS_KEY") or s3.get("secret_access_key") or ""
    endpoint = env.get("AWS_ENDPOINT_URL") or s3.get("endpoint_url") or ""
    out = {"spark.hadoop.fs.s3a.endpoint.region": env.get("AWS_DEFAULT_REGION") or s3.get("region") or "us-east-1"}
    if key and secret:
        out |= {"spark.hadoop.fs.s3a.access.key": key, "spark.hadoop.fs.s3a.secret.key": secret}
    if endpoint:
        out |= {"spark.hadoop.fs.s3a.endpoint": endpoint, "spark.hadoop.fs.s3a.path.style.access": "true"}
    return out
