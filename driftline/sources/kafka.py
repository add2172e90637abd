"""Messages of a broker, as rows (key, value, topic, partition, offset, timestamp) that any Kafka source gives, to rows with ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import composite_id
from ..functions.scalars import base64_text

ORDER = ["timestamp", "partition", "offset"]
SECURITY = {"PLAINTEXT", "SSL", "SASL_PLAINTEXT", "SASL_SSL"}


def options(servers: str, topic: str, group: str | None = None, protocol: str = "PLAINTEXT", sasl: dict[str, str] | None = None, ssl: dict[str, str] | None = None, max_messages: int | None = None) -> dict[str, str]:
    """Options for ``spark.read`` or ``readStream`` of format ``kafka``. What a protocol needs and what it can't use are checked here."""
    protocol = protocol.upper()
    if protocol not in SECURITY:
        raise ValueError(f"unknown protocol: {protocol}")
    if protocol.startswith("SASL") != bool(sasl):
        raise ValueError(f"{protocol} {'needs' if protocol.startswith('SASL') else 'has no'} SASL settings")
    if sasl and {"mechanism", "username", "password"} - set(sasl):
        raise ValueError("SASL needs mechanism, username and password")
    if ssl and "SSL" not in protocol:
        raise ValueError(f"{protocol} has no SSL settings")
    if ssl and ("certificate" in ssl) != ("key" in ssl):
        raise ValueError("a client's certificate and key come together")
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "kafka.security.protocol": protocol}
    if group:
        out["kafka.group.id"] = group
    if sasl:
        module = "plain.PlainLoginModule" if sasl["mechanism"].upper() == "PLAIN" else "scram.ScramLoginModule"
        quoted = {k: sasl[k].replace("\\", "\\\\").replace('"', '\\"') for k in ("username", "password")}
        out |= {"kafka.sasl.mechanism": sasl["mechanism"].upper(), "kafka.sasl.jaas.config": f'org.apache.kafka.common.security.{module} required username="{quoted["username"]}" password="{quoted["password"]}";'}
    if ssl:
        names = {"ca": "kafka.ssl.truststore.certificates", "certificate": "kafka.ssl.keystore.certificate.chain", "key": "kafka.ssl.keystore.key"}
        out |= {names[k]: v for k, v in ssl.items()} | {"kafka.ssl.truststore.type": "PEM"} | ({"kafka.ssl.keystore.type": "PEM"} if "key" in ssl else {})
    if max_messages:
        out["maxOffsetsPerTrigger"] = str(max_messages)
    return out


def batch(spark: SparkSession, **settings) -> DataFrame:
    """A bounded read; needs Spark's Kafka package."""
    return spark.read.format("kafka").options(**options(**settings)).load()


def first_messages(messages: DataFrame, most: int | None, taken: int = 0) -> DataFrame:
    """The earliest messages, as many as are left of ``most`` after those already taken; a top-k, not a sort."""
    if most is None:
        return messages
    return messages.orderBy(*ORDER).limit(max(0, most - taken))


def rows(messages: DataFrame, payload: Column, key_is_id: bool = False, id_columns: list[str] = ["id"]) -> DataFrame:
    """``_id`` and the fields of ``payload`` (a struct, decoded from the value). The id is the key's base64, or the id columns, which then leave the payload; a missing one is an error."""
    read = messages.select("key", payload.alias("p"))
    names = read.schema["p"].dataType.names
    if key_is_id:
        own = F.when(F.col("key").isNotNull(), base64_text(F.col("key"))).otherwise(F.raise_error(F.lit("a message has no key")))
        return read.select(own.alias("_id"), *[F.col(f"p.`{c}`").alias(c) for c in names])
    if missing := [c for c in id_columns if c not in names]:
        raise ValueError(f"messages have no field {', '.join(missing)}")
    part = [F.when(F.col(f"p.`{c}`").isNotNull(), F.col(f"p.`{c}`")).otherwise(F.raise_error(F.lit(f"a message has no {c}"))) for c in id_columns]
    return read.select(composite_id(*part).alias("_id"), *[F.col(f"p.`{c}`").alias(c) for c in names if c not in id_columns])


def json_payload(schema: str) -> Column:
    return F.from_json(F.col("value").cast("string"), schema)
