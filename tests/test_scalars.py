import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewatch import functions as fn
from tidewatch.operators import shaping
from tidewatch.functions.text import json_scalar_text, lua_number


def values(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [row.r for row in df.select("i", column(F.col("v")).alias("r")).orderBy("i").collect()]


def test_titles_become_actions(spark):
    got = values(spark, fn.normalise_action, "New Vehicle Purchase", "📌 [Card Sold] ", "!!!", None, "7 up",
                 "Kelvin", "a" * 63 + "-b")
    assert got == ["new_vehicle_purchase", "card_sold", None, None, "up", "elvin", "a" * 63 + "_"]


def test_severities(spark):
    got = values(spark, fn.normalise_severity, "success", "danger", "ERROR", "critical", "purple", None)
    assert got == ["info", "warning", "warning", "critical", None, None]


@pytest.mark.parametrize("limit", [4, 5, 6, 7, 8, 128])
def test_short_text_never_splits_a_character(spark, limit):
    texts = ["", "abc", "abcdéfgh", "日本語テキスト", "😀😀😀", "x" * 200]
    got = values(spark, lambda c: fn.short_text(c, limit), *texts)
    want = [t.encode()[:limit].decode("utf-8", "ignore") or None for t in texts]
    assert got == want


def test_numbers_are_read_like_the_scripts_do(spark):
    got = values(spark, lua_number, " 12 ", "1e3", "0x10", "-0x10", "1d", "NaN", "", ".5", "5.", "+7", "abc", None)
    assert got == [12, 1000, 16, -16, None, None, None, Decimal("0.5"), 5, 7, None, None]


def test_money_text(spark):
    df = spark.createDataFrame([("**$1,250**",), (",",), ("0123",), ("-",), ("`$3.50`",)], "v string")
    rows = df.select(fn.parse_money_text(F.col("v")).alias("m")).select("m.*").collect()
    assert [(r.text, r.number) for r in rows] == [
        ("$1,250", 1250), (",", None), ("0123", 123), ("-", None), ("$3.50", Decimal("3.5"))]


def test_plates(spark):
    got = values(spark, fn.plate_of, "trunkABC123", "trunk-ABC123", "trunk AB 1", "12", None)
    assert got == ["123", "ABC123", None, None, None]


def test_weapons(spark):
    assert values(spark, fn.weapon_flag, "WEAPON_PISTOL", "ammo-9", "water", None) == [True, True, False, False]


def test_json_scalar_text(spark):
    got = values(spark, json_scalar_text, "6", '"6"', "null", '"a\\"b"', '""', None)
    assert got == ["6", "6", None, 'a"b', "", None]


def test_fields_flatten_with_first_and_explicit_winning(spark):
    fields = F.array(
        F.struct(F.lit("Amount Paid").alias("name"), F.lit(None).cast("string").alias("key"), F.lit("**$1,250**").alias("value")),
        F.struct(F.lit(None).cast("string").alias("name"), F.lit("Plate").alias("key"), F.lit("AB 123").alias("value")),
        F.struct(F.lit("Seller Name").alias("name"), F.lit(None).cast("string").alias("key"), F.lit("-").alias("value")),
        F.struct(F.lit("Amount").alias("name"), F.lit(None).cast("string").alias("key"), F.lit("9").alias("value")),
    )
    row = spark.range(1).select(fn.fields_to_data(fields, fn.json_map(F.lit('{"plate":"KEPT"}'))).alias("d")).first()
    assert row.d == {"amount_paid": "1250", "amount": "1250", "plate": '"KEPT"', "seller_name": '"-"'}


def test_bounded_copy_limits_depth_keys_and_bytes(spark):
    deep = '{"a":{"b":{"c":{"d":{"e":{"f":1}}}}},"long":"' + "é" * 2000 + '","n":null}'
    wide = "{" + ",".join(f'"k{i:03}":{i}' for i in range(100)) + "}"
    got = values(spark, fn.bounded_copy, deep, wide, "broken{", None)
    assert got[0] == '{"a":{"b":{"c":{"d":{"e":{}}}}},"long":"' + "é" * 1024 + '"}'
    assert got[1].count(":") == 64 and '"k063":63' in got[1]
    assert got[2:] == [None, None]


def test_bounded_copy_of_odd_values(spark):
    long, quotes = "x" * 2047, '\\"' * 1030
    odd = ['{"b":[1,null,"t",{"z":[],"a":{}},1.50],"a\\"":true,"\U0001F600":1,"\uFFEE":2}', '["a\\n",-0.0,1e3,null]', "null", '"t"', "7", "{}", "[]",
           f'["{long}é","{long}y","{quotes}"]', '{"k":1,"k":2}', "[[[[[[1]]]]],2]"]
    assert values(spark, fn.bounded_copy, *odd) == [
        '{"a\\"":true,"b":[1,"t",{"a":{},"z":[]},1.5],"\uFFEE":2,"\U0001F600":1}', '["a\\n",0,1000.0,null]'.replace(",null", ""), None, '"t"', "7", "{}", "[]",
        f'["{long}","{long}y","{quotes}"]', '{"k":2}', "[[[[[[]]]]],2]"]


def test_a_computed_text_is_made_before_it_is_bounded(spark):
    """Within the levels, which Spark interprets, it would be made by interpreted code."""
    df = spark.range(1).select(F.concat(F.lit('{"a":'), F.col("id").cast("string"), F.lit("}")).alias("t")).select(fn.bounded_copy(F.col("t")).alias("v"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Project") == 2 and df.first().v == '{"a":0}'


def test_slots_are_objects_or_numbers(spark):
    got = values(spark, fn.read_slot, '{"name":"water","count":2,"slot":3,"metadata":{}}', "7", '"8"', "true")
    assert [r["slot"] for r in got] == [3, 7, 8, None]
    assert got[0]["name"] == "water" and got[0]["count"] == 2 and got[0]["metadata"] is None


def test_fold_key_ignores_amounts_but_not_types(spark):
    def key(data, context='{"coords":[1]}'):
        cols = [F.lit("money").alias("category"), F.lit("paid").alias("action")]
        return spark.range(1).select(fn.fold_key(fn.json_map(F.lit(context)), fn.json_map(F.lit(data)), cols)).first()[0]

    assert key('{"amount":1,"reason":"x"}') == key('{"reason":"x","amount":2,"slot":4}', '{"coords":[2]}')
    assert key('{"reason":"1"}') != key('{"reason":1}')


def test_sql_functions(spark):
    names = fn.register_sql_functions(spark)
    assert "tw_normalise_action" in names
    row = spark.sql("SELECT tw_normalise_action('New Car!') a, tw_normalise_severity('ERROR') s, "
                    "tw_money_number('**$1,250**') m, tw_plate_of('trunk-AB1') p, tw_short_text('日本語', 4) t").first()
    assert (row.a, row.s, row.m, row.p, row.t) == ("new_car", "warning", 1250, "AB1", "日")


def test_sql_functions_equal_the_column_functions(spark):
    fn.register_sql_functions(spark)
    texts = ["", "New Car!", "__x__", "ERROR", "WARNING", "warn", "Danger\n", "İNFO", "Kill", "1", " 7 ", "1e3", "-0x10", "0xFFFFFFFFFFFFFFFF",
             "1e30", "12345678901234567890123", "0.0000001", "**$1,250**", "$1,250\n", ",", "0123", "trunk-AB1", "trunkAB1\n", "glove-", "日本語" * 9,
             "WEAPON_X", "Ammo-9", "weapon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("at", F.lit("2024-01-02 03:04:05.6").cast("timestamp"))
    pairs = {
        "tw_normalise_action(t)": fn.normalise_action(F.col("t")), "tw_normalise_severity(t)": fn.normalise_severity(F.col("t")),
        "tw_number(t)": fn.lua_number(F.col("t")), "tw_money_number(t)": fn.parse_money_text(F.col("t"))["number"],
        "tw_plate_of(t)": fn.plate_of(F.col("t")), "tw_short_text(t, 7)": fn.short_text(F.col("t"), 7),
        "tw_weapon_flag(t)": fn.weapon_flag(F.col("t")), "tw_utc_text(at)": fn.utc_text(F.col("at")),
        "tw_volume_label(nullif(t, ''), 'money', 'paid')": shaping.volume_label(F.nullif(F.col("t"), F.lit("")), F.lit("money"), F.lit("paid")),
    }
    for sql, column in pairs.items():
        rows = df.select("t", F.expr(sql).alias("a"), column.alias("b")).collect()
        assert [(r.t, r.a) for r in rows] == [(r.t, r.b) for r in rows], sql


def test_json_of_texts_and_objects_stays_in_compiled_code(spark):
    from tidewatch.catalog import entries
    from tidewatch.functions.records import json_object
    from tidewatch.functions.text import text_json

    texts = ["", "plain", 'a "b" \\ c', "tab\t", "\x01", "\x7f", "é\u2028😀", "\ufffd", "[x]", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = dict(rows.select("id", text_json(F.col("t"))).collect())
    assert found == {i: None if t is None else json.dumps(t, ensure_ascii=False) for i, t in enumerate(texts)}
    made = json_object(a=F.when(F.col("id") > 1, F.lit("1")), b=F.lit(None), c=text_json(F.col("t")))
    maps = dict(rows.select("id", made).collect())
    assert maps[0] == {"c": '""'} and maps[9] == {"a": "1"} and list(maps[2]) == ["a", "c"]
    broken = spark.sql("SELECT CAST(X'61FF62' AS STRING) AS t").select(text_json(F.col("t"))).first()[0]
    assert broken == '"a\ufffdb"'
    plan = entries()["moves_to_events"].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "map_filter(map(" not in plan
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
