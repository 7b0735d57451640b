from pyspark.sql import functions as F

from tickflow.functions.keys import normalize_symbol
from tickflow.sources.codec import CORRUPT_COLUMN, decode_trades, encode_trades, split_bad, with_trade_time


def _msgs(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_decode_permissive_cases(spark):
    df = _msgs(
        spark,
        [
            '{"symbol":"A","price":1.5}',
            "not json",
            '{"symbol":"A","price":"x"}',
            None,
            '{"symbol":"A","price":2,"extra":1}',
        ],
    )
    rows = decode_trades(df, keep_corrupt=True).collect()
    good, notjson, wrongtype, null, extra = rows
    assert (good.symbol, good.price, good.quantity, good[CORRUPT_COLUMN]) == ("A", 1.5, None, None)
    assert notjson.symbol is None and notjson.price is None and notjson[CORRUPT_COLUMN] == "not json"
    assert wrongtype.symbol == "A" and wrongtype.price is None
    assert wrongtype[CORRUPT_COLUMN] == '{"symbol":"A","price":"x"}'
    assert all(v is None for v in null.asDict().values())
    assert extra.price == 2.0 and extra[CORRUPT_COLUMN] is None


def test_split_bad(spark):
    df = _msgs(spark, ['{"symbol":"A","price":1.5}', "oops", '{"symbol":"B","price":"x"}', '{"price":3}'])
    good, bad = split_bad(decode_trades(df, keep_corrupt=True))
    assert [r.symbol for r in good.collect()] == ["A"]
    assert CORRUPT_COLUMN not in good.columns
    assert bad.count() == 3


def test_narrowed_schema_parses_only_requested_fields(spark):
    df = _msgs(spark, ['{"symbol":"A","price":1.5,"quantity":2.0,"trade_id":7}'])
    out = decode_trades(df, fields=["symbol", "price"])
    assert out.columns == ["symbol", "price"]
    assert "trade_id" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_encode_normalises_and_rounds(spark):
    df = spark.createDataFrame([("BTC-USD", 1.23456789, 101.5)], "symbol string, quantity double, price double")
    text = encode_trades(df).select(F.col("value").cast("string")).first()[0]
    assert '"symbol":"BTCUSD"' in text and '"quantity":1.234568' in text
    back = decode_trades(encode_trades(df)).first()
    assert back.symbol == "BTCUSD" and back.price == 101.5


def test_normalize_symbol_removes_every_dash(spark):
    out = spark.createDataFrame([("A-B-C",)], "s string").select(normalize_symbol("s")).first()[0]
    assert out == "ABC"


def test_trade_time_modes(spark):
    df = spark.createDataFrame([(1704067207179,)], "event_time long")
    ntz = with_trade_time(df, "event_time", as_ntz=True).first().timestamp
    assert str(ntz) == "2024-01-01 00:00:07.179000"
    ltz = with_trade_time(df, "event_time")
    assert dict(ltz.dtypes)["timestamp"] == "timestamp"
    proc = with_trade_time(df, "processing")
    assert dict(proc.dtypes)["timestamp"] == "timestamp"


def test_scale_conf_bounds():
    from tickflow.session import MB, scale_conf

    big = scale_conf(100 * (1 << 40), 4000)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 1024 * MB
    assert big["spark.sql.shuffle.partitions"] == "12000"
    small = scale_conf(10 * MB, 8)
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 128 * MB
