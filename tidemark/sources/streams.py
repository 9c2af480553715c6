"""Streaming sources and pushed rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SourceValidationError
from tidemark.functions.types import check_declared, spark_type
from tidemark.sources.batch import BatchSource


def decode_payload(
    payload: Column, payload_format: str, schema: str, options: dict[str, str] | None = None
) -> Column:
    """Struct column from a message payload.

    ``schema`` is a DDL string for JSON, a JSON schema for Avro and a message name for
    Protobuf (with ``options["descriptor"]`` naming the descriptor file).  Avro and
    Protobuf need Spark's own add-on packages on the class path.
    """
    options = options or {}
    if payload_format == "json":
        return F.from_json(payload.cast("string"), schema, options)
    if payload_format == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(payload, schema, options)
    if payload_format == "protobuf":
        from pyspark.sql.protobuf.functions import from_protobuf

        rest = {k: v for k, v in options.items() if k != "descriptor"}
        return from_protobuf(payload, schema, options.get("descriptor"), rest)
    raise ValueError(f"unknown payload format {payload_format!r}")


@dataclass(frozen=True, kw_only=True)
class StreamSource:
    """A stream read with any Spark streaming reader and, if set, a payload decoder."""

    name: str = ""
    event_timestamp_column: str | None = None
    created_timestamp_column: str | None = None
    field_mapping: dict[str, str] = field(default_factory=dict)
    payload_format: str | None = None
    payload_schema: str = ""
    payload_options: dict[str, str] = field(default_factory=dict)
    format: str = ""
    options: dict[str, str] = field(default_factory=dict)
    stream_schema: str | T.StructType | None = None

    payload_column = "value"

    def reader(self) -> tuple[str, dict[str, str]]:
        """Format and options for ``readStream``."""
        return self.format, self.options

    def read_stream(self, spark: SparkSession) -> DataFrame:
        name, options = self.reader()
        reader = spark.readStream.format(name).options(**options)
        if self.stream_schema is not None:
            reader = reader.schema(self.stream_schema)
        return self.decode(reader.load())

    def decode(self, df: DataFrame) -> DataFrame:
        """Feature rows from raw messages; works the same on a stream and on a batch."""
        if self.payload_format:
            body = decode_payload(
                F.col(self.payload_column),
                self.payload_format,
                self.payload_schema,
                self.payload_options,
            )
            try:
                df = df.select(body.alias("__ft_body")).select("__ft_body.*")
            except AnalysisException as error:
                if "NOT_LOADED" not in str(error.getCondition()):
                    raise
                raise SourceValidationError(
                    f"{self.payload_format} payloads need Spark's add-on spark-{self.payload_format} on the class path"
                ) from error
        return df.withColumnsRenamed(self.field_mapping) if self.field_mapping else df


@dataclass(frozen=True, kw_only=True)
class KafkaSource(StreamSource):
    """Messages of one Kafka topic; needs Spark's Kafka package."""

    bootstrap_servers: str
    topic: str

    def reader(self) -> tuple[str, dict[str, str]]:
        wanted = {"kafka.bootstrap.servers": self.bootstrap_servers, "subscribe": self.topic}
        return "kafka", {**wanted, **self.options}


@dataclass(frozen=True, kw_only=True)
class KinesisSource(StreamSource):
    """Records of one Kinesis stream; needs a Kinesis connector package."""

    region: str
    stream_name: str

    payload_column = "data"

    def reader(self) -> tuple[str, dict[str, str]]:
        wanted = {"region": self.region, "streamName": self.stream_name}
        return self.format or "kinesis", {**wanted, **self.options}


@dataclass(frozen=True, kw_only=True)
class PushSource:
    """Rows handed in by a stream consumer: a schema and an optional batch source."""

    name: str
    schema: dict[str, str | T.DataType]
    batch_source: BatchSource | None = None
    event_timestamp_column: str | None = None
    created_timestamp_column: str | None = None
    field_mapping: dict[str, str] = field(default_factory=dict)

    def check(self, df: DataFrame) -> DataFrame:
        """The rows in the declared columns and types; raises if they do not fit."""
        declared = {name: spark_type(dtype) for name, dtype in self.schema.items()}
        missing = set(declared) - set(df.columns)
        if missing:
            raise SourceValidationError(f"pushed rows lack columns {sorted(missing)}")
        check_declared(df, declared, f"push source {self.name!r}")
        df = df.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in declared.items()])
        return df.withColumnsRenamed(self.field_mapping) if self.field_mapping else df
