"""The jobs on topics, with a reader in the connector's place: the options sent, binary values, offsets overridden."""

import json

import pytest
from pyspark.sql import functions as F

from marketflow.plans import jobs
from marketflow.sources.messages import read_kafka, read_message_files
from marketflow.sources.parquet import read_lake


class TopicSession:
    """The session, but its ``kafka`` format reads landed files, with ``value`` as bytes as the connector gives it."""

    def __init__(self, spark, landing):
        self._spark, self._landing, self.asked = spark, landing, []

    def __getattr__(self, name):
        return getattr(self._spark, name)

    @property
    def readStream(self):
        return TopicReader(self, streaming=True)

    @property
    def read(self):
        return TopicReader(self, streaming=False)


class TopicReader:
    def __init__(self, session, streaming):
        self._session, self._streaming, self._kafka, self._options = session, streaming, False, {}

    def __getattr__(self, name):
        return getattr(self._session._spark.read, name)

    def format(self, name):
        assert name == "kafka"
        self._kafka = True
        return self

    def options(self, **options):
        self._options.update(options)
        return self

    def load(self):
        self._session.asked.append((self._streaming, self._options))
        files = read_message_files(self._session._spark, self._session._landing, streaming=self._streaming)
        return files.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                            F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"))


def land(spark, path, objs):
    lines = [(o if isinstance(o, str) else json.dumps(o),) for o in objs]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)


def master(*tickers):
    return [{"ticker": t, "name": f"n{t}", "market": "stocks", "locale": "us", "primary_exchange": "X", "type": "CS", "active": True,
             "currency_name": "usd", "cik": "1", "last_updated_utc": "2024-01-01T00:00:00Z"} for t in tickers]


def bar(ticker, day):
    return {"T": ticker, "v": 1, "vw": 1.5, "o": 1, "c": 2, "h": 3, "l": 0.5, "n": 1, "date_time": day}


BROKER = {"kafka.bootstrap.servers": "broker:1", "subscribe": "topic"}


def test_master_topic_is_read_from_its_first_offset_once(spark, scratch):
    landing, raw, ckpt = scratch("topic"), scratch("raw"), scratch("ckpt")
    session = TopicSession(spark, landing)
    land(spark, landing, master("A", "B"))
    assert jobs.ingest_master_from_kafka(session, BROKER, raw, ckpt) == 2
    land(spark, landing, master("C"))
    assert jobs.ingest_master_from_kafka(session, {**BROKER, "startingOffsets": "latest"}, raw, ckpt) == 1
    assert [o["startingOffsets"] for _, o in session.asked] == ["earliest", "latest"]
    assert all(streaming and "failOnDataLoss" not in o and o["subscribe"] == "topic" for streaming, o in session.asked)
    assert sorted(r.ticker for r in spark.read.parquet(raw).collect()) == ["A", "B", "C"]


def test_bar_topic_is_read_from_new_offsets_and_tolerates_lost_ones(spark, scratch):
    topic, names, raw, cleaned, lake = (scratch(n) for n in ("topic", "names", "raw", "cleaned", "lake"))
    land(spark, names, master("A", "B"))
    jobs.ingest_master(spark, read_message_files(spark, names, streaming=True), raw, scratch("ckpt-master"))
    jobs.clean_master_table(spark, raw, cleaned)
    session, ckpt = TopicSession(spark, topic), scratch("ckpt")
    land(spark, topic, [bar("A", "2024-06-04"), bar("Z", "2024-06-05"), bar("B", "2024-05-01"), "{broken"])
    routes = jobs.enrich_kafka_to_lake(session, BROKER, cleaned, lake, ckpt, cut="2024-06-03")
    assert sum(routes.values()) == 4 and sorted(routes.values()) == [1, 1, 1, 1]
    land(spark, topic, [bar("B", "2024-07-01")])
    again = jobs.enrich_kafka_to_lake(session, {**BROKER, "failOnDataLoss": "true", "maxOffsetsPerTrigger": "5"}, cleaned, lake, ckpt,
                                      cut="2024-06-03")
    assert sum(again.values()) == 1
    assert [(o["startingOffsets"], o["failOnDataLoss"], o.get("maxOffsetsPerTrigger")) for _, o in session.asked] == [
        ("latest", "false", None), ("latest", "true", "5")]
    assert sorted(r.ticker for r in read_lake(spark, lake).collect()) == ["A", "B"]


@pytest.mark.parametrize("streaming", [True, False])
def test_options_reach_the_reader_as_given(spark, scratch, streaming):
    landing = scratch("topic")
    land(spark, landing, master("A"))
    session = TopicSession(spark, landing)
    df = read_kafka(session, {**BROKER, "startingOffsets": "earliest"}, streaming=streaming)
    assert df.isStreaming == streaming and dict(df.dtypes)["value"] == "binary"
    assert session.asked == [(streaming, {**BROKER, "startingOffsets": "earliest"})]
