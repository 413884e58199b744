import pytest
from conftest import DATA
from pyspark.sql import functions as F

from socialog.functions import codec, labels
from socialog.operators import normalize
from socialog.plans import fixtures as fx
from socialog.sources import schemas

EMBEDS = "array<struct<url: string, cast_id: struct<fid: bigint, hash: binary>>>"


def one(spark, schema, value, column):
    return spark.createDataFrame([(value,)], schema).select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, text", [(b"\x01\xab", "0x01ab"), (b"", ""), (None, "")]
)
def test_hex_text(spark, value, text):
    assert one(spark, "v binary", value, codec.hex_text) == text
    assert one(spark, "v binary", value, codec.plain_hex) == text.removeprefix("0x")


def test_cast_id_wins_over_url(spark):
    embeds = [("http://u", (7, b"\x0f")), ("http://u", None), ("", None)]
    text = one(spark, f"v {EMBEDS}", embeds, codec.embeds_text)
    assert text == '{ "castId": { "fid": "7", "hash": "0x0f" } }|{ "url": "http://u" }|'


@pytest.mark.parametrize(
    "url", ["http://a|b", 'http://a"b', "http://a\\b\nc", 'http://x }|{ y', "http://a|{ b }"]
)
def test_odd_urls_come_back_whole(spark, url):
    text = '{ "url": "' + url + '" }|{ "castId": { "fid": "7", "hash": "0x0f" } }'
    first, second = one(spark, "v string", text, codec.parse_embeds)
    assert (first["url"], first["castId"]) == (url, None)
    assert (second["url"], tuple(second["castId"])) == (None, (7, "0x0f"))


def test_blanks_parse_to_nothing(spark):
    assert one(spark, "v string", "", codec.parse_cast_id) is None
    assert one(spark, "v string", "", codec.parse_mentions) == []
    assert one(spark, "v string", "", codec.parse_embeds) == []


def test_bad_numbers_read_null(spark):
    assert tuple(one(spark, "v string", "x:0xaa", codec.parse_cast_id)) == (None, "0xaa")
    assert one(spark, "v string", "1,x,3", codec.parse_mentions) == [1, None, 3]


def test_unknown_field_label(spark):
    fields = ("Pfp", "Display", "Bio", "Url", "Username", None)
    got = [one(spark, "v string", f, labels.field_label) for f in fields]
    assert got == ["Profile Picture", "Display Name", "Bio", "URL", "Unknown", "Unknown"]


@pytest.mark.parametrize("size, text", [(100, "x" * 100), (101, "x" * 100 + "...")])
def test_preview(spark, size, text):
    assert one(spark, "v string", "x" * size, labels.preview) == text


@pytest.mark.parametrize(
    "ms, band", [(999, "near real time"), (1000, "normal"), (5000, "normal"), (5001, "high")]
)
def test_latency_band(spark, ms, band):
    assert one(spark, "v bigint", ms, labels.latency_band) == band


def test_message_without_data_flattens_to_blanks(spark):
    messages = spark.createDataFrame([(None,) * len(schemas.MESSAGE)], schemas.MESSAGE)
    for kind, convert in normalize.FLATTEN.items():
        row = convert(messages).first().asDict()
        assert row.pop("MessageType") == "Unknown" and row.pop("SignatureScheme") == "None"
        assert set(row.values()) <= {"", 0}, kind
    assert normalize.flatten_casts(messages).schema.names == schemas.CASTS.names


def test_flat_schemas_are_as_declared(spark):
    for kind in schemas.FLAT:
        flat = normalize.flatten(fx.messages(spark, DATA, kind), kind)
        assert [(f.name, f.dataType) for f in flat.schema] == [
            (f.name, f.dataType) for f in schemas.FLAT[kind]
        ]


def test_own_converter_replaces_the_built_in(spark):
    flat = normalize.flatten(fx.link_messages(spark, DATA), "links", lambda m: m.select("hash"))
    assert flat.columns == ["hash"]


def test_bad_rows_are_marked_and_kept(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    rows = normalize.keep_parsable(df, "n", F.col("v").try_cast("int")).collect()
    assert [(r["n"], r["failed"]) for r in rows] == [(1, False), (None, True)]


def test_schema_of_row():
    sample = {"a": 1, "b": "x", "c": 1.5, "d": True, "e": b"", "f": None, "g": [1]}
    kinds = [f.dataType.typeName() for f in schemas.schema_of_row(sample)]
    assert kinds == ["long", "string", "double", "boolean", "binary", "string", "string"]
