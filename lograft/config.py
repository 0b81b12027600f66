"""Job configuration as frozen dataclasses built from string property groups.

A deployment hands each job a ``dict[str, dict[str, str]]`` of named property
groups; ``from_properties`` turns one group into a typed, validated object.
Secrets are masked in ``repr`` so configs can be logged safely.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Mapping

# Property group names, defaults and accepted settings, as the
# jobs this library replaces read them.
GROUP_MYSQL = "MySQLSrcCDC"
GROUP_ORACLE = "OracleSrcCDC"
GROUP_POSTGRES = "PgSrcCDC"
GROUP_MONGO = "MongoSrcCDC"
GROUP_KAFKA = "MSKTargetCDC"
GROUP_KINESIS = "KDSTargetCDC"

DEFAULT_TOPIC_PREFIX = "cdc-"
DEFAULT_TIME_ZONE = "Asia/Shanghai"
NO_PK = "no_pk"
NO_TABLE = "no_table"

STARTUP_MODES = {
    "mysql": ("initial", "earliest-offset", "latest-offset", "snapshot"),
    "oracle": ("initial", "latest-offset"),
    "postgres": ("initial",),
}
SINK_TARGETS = ("msk", "kds")

_SECRET_KEYS = ("password", "dbPwd", "pwd")


def _bool(value: str | None, default: bool) -> bool:
    # Java's Boolean.parseBoolean: only a case-insensitive "true" is true.
    if value is None:
        return default
    return value.lower() == "true"


def _masked_repr(obj) -> str:
    parts = []
    for f in fields(obj):
        v = getattr(obj, f.name)
        if f.name in ("password",) and v is not None:
            v = "***"
        parts.append(f"{f.name}={v!r}")
    return f"{type(obj).__name__}({', '.join(parts)})"


@dataclass(frozen=True, repr=False)
class RelationalSource:
    """A relational change source (MySQL, PostgreSQL or Oracle flavour)."""

    kind: str
    pk: str = "id"
    stringify: bool = False
    startup_mode: str = "initial"
    time_zone: str | None = None
    databases: str | None = None
    schemas: str | None = None
    tables: str | None = None
    host: str | None = None
    port: int | None = None
    user: str | None = None
    password: str | None = None
    position_field: str = "pos"
    position_col: str | None = None

    @property
    def table_qualifier(self) -> str:
        """What precedes the table in an include list: the database, or the schema."""
        return "db" if self.kind == "mysql" else "schema"

    def __post_init__(self):
        if self.kind not in STARTUP_MODES:
            raise ValueError(f"unknown relational source kind {self.kind!r}")
        if self.startup_mode not in STARTUP_MODES[self.kind]:
            raise ValueError(
                f"startup mode {self.startup_mode!r} is not supported for {self.kind}; "
                f"expected one of {STARTUP_MODES[self.kind]}"
            )

    __repr__ = _masked_repr

    @classmethod
    def from_properties(cls, kind: str, props: Mapping[str, str]) -> "RelationalSource":
        port = props.get("port")
        common = dict(
            kind=kind,
            databases=props.get("db"),
            schemas=props.get("schemas"),
            tables=props.get("tables"),
            host=props.get("host"),
            port=int(port) if port else None,
            user=props.get("dbUser"),
            password=props.get("dbPwd"),
            position_field=props.get("positionField", "pos"),
            position_col=props.get("positionColumn"),
        )
        if kind == "mysql":
            return cls(
                pk=props.get("pk", "id"),
                stringify=_bool(props.get("stringifyData"), True),
                startup_mode=props.get("startupMode", "initial"),
                time_zone=props.get("timeZone", DEFAULT_TIME_ZONE),
                **common,
            )
        if kind == "oracle":
            return cls(
                pk=props.get("pk", "ID"),
                stringify=_bool(props.get("stringifyData"), False),
                startup_mode=props.get("startupMode", "initial"),
                **common,
            )
        if kind == "postgres":
            # PostgreSQL images are always stringified; there is no option.
            return cls(pk=props.get("pk", "id"), stringify=True, **common)
        raise ValueError(f"unknown relational source kind {kind!r}")


@dataclass(frozen=True, repr=False)
class DocumentSource:
    """A document-store change source (MongoDB flavour)."""

    databases: str | None = None
    collections: str | None = None
    copy_existing: bool = True
    sink_target: str = "msk"
    host: str | None = None
    user: str | None = None
    password: str | None = None
    position_field: str = "pos"
    position_col: str | None = None

    def __post_init__(self):
        if self.sink_target not in SINK_TARGETS:
            raise ValueError(f"unknown sinkTarget {self.sink_target!r}; expected one of {SINK_TARGETS}")

    __repr__ = _masked_repr

    @property
    def startup_mode(self) -> str:
        return "initial" if self.copy_existing else "latest-offset"

    @classmethod
    def from_properties(cls, props: Mapping[str, str]) -> "DocumentSource":
        return cls(
            databases=props.get("databases"),
            collections=props.get("collections"),
            copy_existing=_bool(props.get("copyExisting"), True),
            sink_target=props.get("sinkTarget", "msk"),
            host=props.get("host"),
            user=props.get("userName"),
            password=props.get("password"),
            position_field=props.get("positionField", "pos"),
            position_col=props.get("positionColumn"),
        )


@dataclass(frozen=True)
class KafkaTarget:
    """Kafka destination: one fixed topic, or one topic per database."""

    brokers: str | None = None
    topic: str | None = None
    per_db_topic_prefix: str | None = None
    per_db_topics: bool = False
    delivery_guarantee: str = "exactly-once"
    partitions: int | None = None
    topic_partitions: Mapping[str, int] = field(default_factory=dict)
    acks: str = "all"
    allow_duplicates: bool = False

    def __post_init__(self):
        if not self.per_db_topics and not self.topic:
            raise ValueError("a fixed-topic Kafka target needs 'topic'")
        if self.partitions is None:
            # A default would send every event of a wider topic to partition 0.
            raise ValueError("a Kafka target needs 'partitions', the number of partitions of its topics")
        if self.partitions < 1 or any(n < 1 for n in self.topic_partitions.values()):
            raise ValueError("partition counts must be positive")

    @property
    def topic_prefix(self) -> str:
        # An empty or missing prefix falls back to the default.
        return self.per_db_topic_prefix or DEFAULT_TOPIC_PREFIX

    @classmethod
    def from_properties(cls, props: Mapping[str, str]) -> "KafkaTarget":
        per_db = "perDBTopicPrefix" in props  # presence, not value, selects the mode
        topic_partitions = {}
        for item in (props.get("topicPartitions") or "").split(","):
            if item.strip():
                name, n = item.rsplit(":", 1)
                topic_partitions[name.strip()] = int(n)
        dg = "at-least-once" if props.get("deliveryGuarantee") == "at-least-once" else "exactly-once"
        return cls(
            brokers=props.get("kafkaBrokers"),
            topic=props.get("topic"),
            per_db_topic_prefix=props.get("perDBTopicPrefix"),
            per_db_topics=per_db,
            delivery_guarantee=dg,
            partitions=int(props["partitions"]) if "partitions" in props else None,
            topic_partitions=topic_partitions,
            allow_duplicates=_bool(props.get("allowDuplicates"), False),
        )


@dataclass(frozen=True)
class KinesisTarget:
    stream_name: str
    region: str | None = None
    max_retries: int = 3

    @classmethod
    def from_properties(cls, props: Mapping[str, str]) -> "KinesisTarget":
        return cls(
            stream_name=props["streamName"],
            region=props.get("region"),
            max_retries=int(props.get("maxRetries", "3")),
        )
