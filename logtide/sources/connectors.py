"""Option builders for the Kafka, JDBC and Snowflake connectors.

The connector jars are the cluster's to provide.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def _required(name: str) -> str:
    value = os.getenv(name)
    if not value:
        raise ValueError(f"environment variable {name} is not set")
    return value


# Polls of the topic that make one step of a stream.
POLLS_PER_STEP = 100


@dataclass
class KafkaSettings:
    """A topic. A step of a stream takes ``POLLS_PER_STEP`` polls of ``batch_size``
    messages at most, and never more than ``max_records``, the limit of a run."""

    bootstrap_servers: str
    topic: str
    batch_size: int = 100
    max_records: int | None = None

    @classmethod
    def from_env(cls) -> KafkaSettings:
        limit = os.getenv("KAFKA_MAX_RECORDS")
        return cls(
            bootstrap_servers=os.getenv("KAFKA_BOOTSTRAP_SERVERS", "localhost:29092"),
            topic=_required("KAFKA_TOPIC"),
            batch_size=int(os.getenv("KAFKA_BATCH_SIZE", "100")),
            max_records=int(limit) if limit else None,
        )

    def source_options(self) -> dict[str, str]:
        """Read from the earliest offset; the checkpoint keeps the position."""
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": "earliest",
        }
        step = self.batch_size * POLLS_PER_STEP
        options["maxOffsetsPerTrigger"] = str(min(step, self.max_records or step))
        return options

    def sink_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "topic": self.topic,
            "kafka.acks": "all",
        }

    def send(self, messages: DataFrame) -> None:
        """Write one batch of keyed messages to the topic."""
        messages.write.format("kafka").options(**self.sink_options()).save()


def kafka_stream(spark: SparkSession, settings: KafkaSettings) -> DataFrame:
    """Messages as text with the offsets that order copies of a key."""
    stream = spark.readStream.format("kafka").options(**settings.source_options()).load()
    return stream.selectExpr("cast(value AS string) AS value", "partition", "offset")


def kafka_writer(messages: DataFrame, settings: KafkaSettings, checkpoint: str) -> DataStreamWriter:
    writer = messages.writeStream.format("kafka").options(**settings.sink_options())
    return writer.option("checkpointLocation", checkpoint)


@dataclass
class PostgresSettings:
    host: str
    database: str
    user: str
    password: str
    port: int = 5432

    @classmethod
    def from_env(cls) -> PostgresSettings:
        return cls(
            host=_required("POSTGRES_HOST"),
            database=_required("POSTGRES_DB"),
            user=_required("POSTGRES_USER"),
            password=_required("POSTGRES_PASSWORD"),
            port=int(os.getenv("POSTGRES_PORT", "5432")),
        )

    def options(
        self,
        table: str,
        partition_column: str | None = None,
        bounds: tuple[int, int] | None = None,
        partitions: int = 64,
    ) -> dict[str, str]:
        """Reader and writer options; a partition column splits the read."""
        options = {
            "url": f"jdbc:postgresql://{self.host}:{self.port}/{self.database}",
            "driver": "org.postgresql.Driver",
            "user": self.user,
            "password": self.password,
            "dbtable": table,
            "fetchsize": "10000",
            "batchsize": "10000",
        }
        if partition_column:
            if bounds is None:
                raise ValueError("a partition column needs its lowest and highest value")
            options.update(
                partitionColumn=partition_column,
                lowerBound=str(bounds[0]),
                upperBound=str(bounds[1]),
                numPartitions=str(partitions),
            )
        return options

    def read(self, spark: SparkSession, table: str, **split) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(table, **split)).load()

    def write(self, df: DataFrame, table: str, mode: str = "append") -> None:
        df.write.format("jdbc").options(**self.options(table)).mode(mode).save()


@dataclass
class SnowflakeSettings:
    account: str
    user: str
    private_key_file: str
    warehouse: str
    database: str
    role: str

    @classmethod
    def from_env(cls) -> SnowflakeSettings:
        return cls(
            account=_required("SNOWFLAKE_ACCOUNT"),
            user=_required("SNOWFLAKE_USER"),
            private_key_file=os.path.expanduser(_required("SNOWFLAKE_PRIVATE_KEY_FILE")),
            warehouse=_required("SNOWFLAKE_WAREHOUSE"),
            database=_required("SNOWFLAKE_DATABASE"),
            role=_required("SNOWFLAKE_ROLE"),
        )

    def options(self, schema: str, table: str, private_key: str) -> dict[str, str]:
        return {
            "sfURL": f"{self.account}.snowflakecomputing.com",
            "sfUser": self.user,
            "pem_private_key": private_key,
            "sfWarehouse": self.warehouse,
            "sfDatabase": self.database,
            "sfRole": self.role,
            "sfSchema": schema,
            "dbtable": table,
        }
