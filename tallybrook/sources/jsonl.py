"""JSON-lines feeds: warehouse receipts and supplier invoices, from files, directories as streams, or Kafka where its connector is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions.columns import pii_hash

ERP_REQUIRED = ("invoice_id", "po_no", "vendor_id", "invoice_amount", "invoice_timestamp")
WMS_REQUIRED = ("wh_id", "po_no", "vendor_id", "upc_no", "qty_received", "received_timestamp")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value): a line each, from paths or globs."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).text(path)


def kafka_options(servers: str, topic: str, starting: str = "earliest", per_trigger: int | None = None, **more: str) -> dict[str, str]:
    """Options of a Kafka reader: where to start (earliest, latest or offsets as JSON), how many messages a trigger reads, and any others with dots as double underscores."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "true"}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options | {k.replace("__", "."): v for k, v in more.items()}


def stream_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """(value) of a topic, decoded from UTF-8; needs Spark's Kafka connector on the class path."""
    return decoded(spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load().select("value"))


def decoded(messages: DataFrame) -> DataFrame:
    return messages.select(F.decode("value", "UTF-8").alias("value"))


def iso_time(text: Column) -> Column:
    """ISO-8601 to a timestamp; without a zone it is UTC (the session's zone); null if it is neither form."""
    return F.coalesce(
        text.try_cast("timestamp"),
        *(F.try_to_timestamp(text, F.lit(p)) for p in ("yyyyMMdd'T'HHmmssX", "yyyyMMdd'T'HHmmss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")),
    )


def _parsed(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("value").alias("raw"), F.from_json("value", "map<string,string>").alias("m"))


def _checked(rows: DataFrame, required: tuple[str, ...], typed: dict[str, Column], extra: dict[str, Column]) -> DataFrame:
    """The typed columns, and ``err``: why the line is a dead letter, else null. JSON null in a required key is a dead letter too."""
    field = lambda k: F.col("m")[k]
    bad = F.when(F.col("m").isNull(), F.lit("not a JSON object"))
    for k in required:
        bad = bad.when(field(k).isNull(), F.lit(f"missing {k}"))
    for k, value in typed.items():
        bad = bad.when(value.isNull(), F.lit(f"bad {k}"))
    columns = {k: field(k) for k in required} | typed | extra
    return rows.select("raw", bad.alias("err"), *(c.alias(k) for k, c in columns.items()))


def parse_erp(lines: DataFrame) -> DataFrame:
    """raw, err and the invoice columns. Amounts may be numbers or texts; bank details leave only as a hash."""
    m = lambda k: F.col("m")[k]
    typed = {"invoice_amount": m("invoice_amount").try_cast("double"), "invoice_timestamp": iso_time(m("invoice_timestamp"))}
    extra = {"bank_account_hash": pii_hash(m("bank_account_details")), "upc_no": m("upc_no"), "email_id": m("email_id"), "event_uuid": F.coalesce(m("event_uuid"), line_id(F.col("raw")))}
    return _checked(_parsed(lines), ERP_REQUIRED, typed, extra)


def parse_wms(lines: DataFrame) -> DataFrame:
    """raw, err and the receipt columns. A JSON number of pieces is truncated, a text must be a whole number."""
    m = lambda k: F.col("m")[k]
    quantity = m("qty_received")
    is_text = F.get_json_object("raw", "$.qty_received").isNotNull() & F.regexp_like("raw", F.lit(r'"qty_received"\s*:\s*"'))
    typed = {
        "qty_received": F.when(is_text, F.when(F.regexp_like(quantity, F.lit(r"^\s*[+-]?\d+\s*$")), F.trim(quantity).try_cast("long"))).otherwise(quantity.try_cast("double").try_cast("long")),
        "received_timestamp": iso_time(m("received_timestamp")),
    }
    return _checked(_parsed(lines), WMS_REQUIRED, typed, {"event_uuid": F.coalesce(m("event_uuid"), line_id(F.col("raw")))})


def line_id(raw: Column) -> Column:
    """An id in the form of a uuid from a line's SHA-256: the same line has the same id whenever it is read."""
    h = F.sha2(raw, 256)
    return F.concat_ws("-", *(F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def masked(raw: Column) -> Column:
    """A line without the value of its bank details, as far as they stand as in JSON: fit to be kept, and to be read again once it is mended."""
    return F.regexp_replace(raw, r'("bank_account_details"\s*:\s*)("(?:[^"\\]|\\.)*"?|[^,}\s]+)', '$1"***"')


def dead_letters(bad: DataFrame, feed: str, now: Column) -> DataFrame:
    """Dead letters (raw, err) as rows of their layer: the masked line, its id, the reason, the feed and the time."""
    return bad.select(line_id(F.col("raw")).alias("line_id"), masked(F.col("raw")).alias("raw"), "err", F.lit(feed).alias("feed"), now.alias("ingested_at"))


def split_ok(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without raw and err, and dead letters (raw, err). The raw line of a good invoice goes no further: it holds bank details."""
    return parsed.where("err is null").drop("raw", "err"), parsed.where("err is not null").select("raw", "err")
