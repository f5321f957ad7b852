import pytest
from conftest import tuples
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidewell import schemas
from tidewell.scratch import scratch_dir, scratch_root
from tidewell.session import ROCKSDB_STATE, build_session
from tidewell.sources import files, jdbc, kafka, live


def test_session_settings_override_defaults(spark):
    same = build_session("again", [("spark.sql.session.timeZone", "UTC")], shuffle_partitions=4)
    assert same.conf.get("spark.sql.shuffle.partitions") == "4"
    assert same.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB_STATE


def test_scratch_is_below_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(root + "/x-")


def test_scratch_refuses_a_machine_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type(
            "Context", (), {"master": "spark://host:7077", "getConf": lambda self: Conf()}
        )()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Cluster())


def test_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo\r\nthree\rfour")
    assert [r[0] for r in tuples(files.read_lines(spark, str(tmp_path)))] == [
        "one", "", "two", "three", "four",
    ]


def test_csv_with_and_without_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text("name;age;job\nann;30;dev\nbob;x;ops\n")
    inferred = files.read_csv_inferred(spark, str(tmp_path / "h.csv"))
    assert inferred.dtypes == [("name", "string"), ("age", "string"), ("job", "string")]
    (tmp_path / "n.csv").write_text("ann;30;dev\nbob;x;ops\n")
    typed = files.read_csv_typed(spark, str(tmp_path / "n.csv"))
    assert tuples(typed) == [("ann", 30, "dev"), ("bob", None, "ops")]
    good = tmp_path / "g.csv"
    good.write_text("name;age\nann;30\n")
    assert files.read_csv_inferred(spark, str(good)).dtypes[1] == ("age", "int")


def test_positional(spark, tmp_path):
    names = "a b c"
    (tmp_path / "p.txt").write_text('1,2,3,4\n"x,y",z\n')
    frame = files.read_positional(spark, str(tmp_path), names)
    assert tuples(frame) == [("1", "2", "3"), ('"x', 'y"', "z")]
    assert tuples(files.read_positional(spark, str(tmp_path), "a b c d e"))[0][4] is None


def test_repeated_names_are_refused(spark):
    with pytest.raises(ValueError, match="g, i"):
        schemas.strings("a b c d e f g h i g k i l")


def test_inline_rows_cast_to_text(spark):
    rows = [("Harbour", 7), (None, None)]
    got = tuples(files.inline_rows(spark, rows, schemas.KEY_VALUE))
    assert got == [("Harbour", "7"), (None, None)]
    typed = StructType([StructField("k", StringType()), StructField("n", IntegerType())])
    assert tuples(files.inline_rows(spark, [("a", 1)], typed)) == [("a", 1)]


def test_stream_files_checks_arguments(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        files.stream_files(spark, str(tmp_path), "avro")
    with pytest.raises(ValueError, match="schema"):
        files.stream_files(spark, str(tmp_path), "json")
    with pytest.raises(ValueError, match="not both"):
        files.stream_files(spark, str(tmp_path), max_files=1, max_bytes=1)
    for fmt in files.STREAM_FORMATS:
        stream = files.stream_files(spark, str(tmp_path), fmt, schemas.LINE, max_files=1)
        assert stream.isStreaming and stream.columns == ["value"]


def test_socket_source_is_described_without_connecting(spark):
    assert live.socket_options("host", 9999) == {"host": "host", "port": "9999"}
    assert live.socket_options("h", 1, with_time=True)["includeTimestamp"] == "true"


def test_rate_schema(spark):
    want = [("timestamp", "timestamp"), ("value", "bigint")]
    assert live.rate_rows(spark, rows_per_second=50, partitions=2).dtypes == want
    assert live.rate_batches(spark, rows_per_batch=5).dtypes == want


# -- Kafka: options and encoding only, the connector is not installed ------------------


def test_kafka_options():
    target = kafka.KafkaTarget(
        "a:9092,b:9092", "SASL_PLAINTEXT", "SCRAM-SHA-256", 'me"', "p\\w", {"kafka.acks": "all"}
    )
    assert kafka.read_options(
        target, "t1", max_offsets=10000, min_partitions=8, startingOffsets="earliest"
    ) == {
        "kafka.bootstrap.servers": "a:9092,b:9092",
        "kafka.security.protocol": "SASL_PLAINTEXT",
        "kafka.sasl.mechanism": "SCRAM-SHA-256",
        "kafka.sasl.jaas.config": (
            "org.apache.kafka.common.security.scram.ScramLoginModule required "
            'username="me\\"" password="p\\\\w";'
        ),
        "kafka.acks": "all",
        "subscribe": "t1",
        "maxOffsetsPerTrigger": "10000",
        "minPartitions": "8",
        "startingOffsets": "earliest",
    }
    assert kafka.write_options(kafka.KafkaTarget("a:1"), "out") == {
        "kafka.bootstrap.servers": "a:1",
        "topic": "out",
    }
    assert "p\\w" not in repr(target)


def test_kafka_encoding(spark):
    rows = spark.createDataFrame([(1, "x")], "n int, word string")
    assert tuples(kafka.encode(rows)) == [(None, '{"n":1,"word":"x"}')]
    assert tuples(kafka.encode(rows, "word", "n")) == [("1", "x")]
    pairs = spark.createDataFrame([("Harbour", 7)], "key string, value int")
    assert tuples(kafka.encode(pairs)) == [("Harbour", "7")]
    raw = spark.createDataFrame([(bytearray(b"hi"),)], "value binary")
    assert tuples(kafka.decode_value(raw)) == [("hi",)]


# -- JDBC: what is handed to Spark; no database is started here ---------------------------


@pytest.fixture
def calls(monkeypatch):
    seen = []

    def read(self, *args, **kwargs):
        seen.append(("read", args, kwargs))
        return "frame"

    def write(self, *args, **kwargs):
        seen.append(("write", args, kwargs))

    option = DataFrameWriter.option

    def keep_option(self, key, value):
        seen.append(("option", key, value))
        return option(self, key, value)

    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameWriter, "option", keep_option)
    return seen


TARGET = jdbc.JdbcTarget("db.example.org", "me", "secret")
PROPERTIES = {"user": "me", "password": "secret", "driver": "com.mysql.cj.jdbc.Driver"}
URL = "jdbc:mysql://db.example.org:3306/shop"


def test_jdbc_target():
    assert TARGET.url("shop") == URL
    assert TARGET.properties() == PROPERTIES
    assert TARGET.properties({"driver": "d", "useSSL": "false"}) == {
        **PROPERTIES, "driver": "d", "useSSL": "false",
    }
    assert "secret" not in repr(TARGET)
    assert "driver" not in jdbc.JdbcTarget("h", "u", "p", 1, "other").properties()


def test_jdbc_read(spark, calls):
    assert jdbc.read_jdbc(spark, TARGET, "shop", "t", {"useSSL": "false"}) == "frame"
    jdbc.read_jdbc(spark, TARGET, "shop", "t", split_column="id", lower=0, upper=9, partitions=3)
    want = {"url": URL, "table": "t", "properties": {**PROPERTIES, "useSSL": "false"}}
    assert calls[0] == ("read", (), want)
    split = {"column": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    assert calls[1] == ("read", (), {"url": URL, "table": "t", "properties": PROPERTIES, **split})
    with pytest.raises(ValueError, match="together"):
        jdbc.read_jdbc(spark, TARGET, "shop", "t", split_column="id")


def test_jdbc_write(spark, calls):
    frame = spark.range(3)
    jdbc.write_jdbc(frame, TARGET, "shop", "t")
    jdbc.write_jdbc(frame, TARGET, "shop", "t", "overwrite", "id FLOAT", truncate=True)
    jdbc.insert_partitions(frame, TARGET, "shop", "t", connections=2)
    jdbc.overwrite_each_batch(TARGET, "shop", "total", prefix="test_", connections=1)(frame, 7)

    def write(table, mode):
        return ("write", (URL, table), {"mode": mode, "properties": PROPERTIES})

    assert calls == [
        write("t", "ignore"),
        ("option", "createTableColumnTypes", "id FLOAT"),
        ("option", "truncate", "true"),
        write("t", "overwrite"),
        write("t", "append"),
        write("test_total", "overwrite"),
    ]
