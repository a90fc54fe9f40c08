import pytest
from pyspark.sql import functions as F

from medallion.operators import quality as Q
from medallion.plans import prices as P
from medallion.sources.delimited import accepted, landed, read_delimited, rejected, write_delimited
from medallion.sources.testdata import PRICE_COLUMNS

ROW = ["2003-01-15", "Battambang", "Battambang", "Battambang", "639", "13.1", "103.2",
       "cereals and tubers", "Rice (mixed, low quality)", "165", "KG", "actual", "Wholesale", "KHR", "500", "0.13"]


def text_rows(spark, rows):
    return P.as_bronze_text(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in PRICE_COLUMNS)))


def variant(**kw):
    r = dict(zip(PRICE_COLUMNS, ROW))
    r.update(kw)
    return [r[c] for c in PRICE_COLUMNS]


def test_quoted_comma_survives_csv(spark, tmp_root):
    rows = [variant(), variant(priceflag="actual,aggregate", market=" padded ")]
    src = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in PRICE_COLUMNS))
    path = f"{tmp_root}/csv"
    write_delimited(src, path)
    back = read_delimited(spark, path, PRICE_COLUMNS).collect()
    assert sorted(tuple(r) for r in back) == sorted(tuple(r) for r in rows)


def test_columns_are_bound_by_each_files_header(spark, tmp_root):
    import pathlib

    files = {
        "a": 'a,b,c\n1,"2,x",3\n4,5\n6,7,8,9\n10,,\n', "sub/b": 'c, extra ,a,b\nC,E,A,B\n"q ""z""",e,p,q\n', "c": "a,b,usd\n1,2,3\n",
        "d": "", "e": "a,b,c\n", "f": "a,a,b,c\n1,2,3,4\n", "g": 'a,b,c\n1,"two\nlines",3\n', "h": "\ufeffB;b,b,c,a\nx,y,z,w\n",
    }
    for name, text in files.items():
        path = pathlib.Path(tmp_root, "in", f"{name}.csv")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    rows = landed(spark, f"{tmp_root}/in", ["a", "b", "c"])
    good = accepted(rows, ["a", "b", "c"])
    assert sorted(map(tuple, good.collect()), key=str) == sorted(
        [("1", "2,x", "3"), ("10", None, None), ("A", "B", "C"), ("p", "q", 'q "z"'), ("w", "y", "z")], key=str)
    assert good.count() == 5 and sorted(r.b or "" for r in good.select("b").collect()) == ["", "2,x", "B", "q", "y"]
    assert sorted((r.line, r.reject_reasons) for r in rejected(rows).collect()) == sorted([
        ("4,5", "row: not 3 fields"), ("6,7,8,9", "row: not 3 fields"), ('1,"two', "row: not 3 fields"), ('lines",3', "row: not 3 fields"),
        ("1,2,3", "header: lacks c"), ("1,2,3,4", "header: names a twice"),
    ])
    whole = landed(spark, f"{tmp_root}/in/g.csv", ["a", "b", "c"], multiline=True)
    assert [tuple(r) for r in accepted(whole, ["a", "b", "c"]).collect()] == [("1", "two\nlines", "3")]


def test_a_broken_column_names_some_of_its_values(spark):
    df = spark.range(500).selectExpr("concat('u', lpad(id, 3, '0')) AS unit")
    with pytest.raises(Q.UnmappedValuesError, match=r"u000, u001, u002 and 497 more$"):
        Q.require_vocabulary(df, "unit", ["KG"], named=3)


def test_bronze_typing_nulls_bad_values(spark):
    bronze = P.bronze_prices(spark.createDataFrame([variant(date="15/01/2003", price="n/a")], ", ".join(f"{c} string" for c in PRICE_COLUMNS)))
    r = bronze.first()
    assert r["price_date"] is None and r["price"] is None and r["market_id"] == 639 and r["source"] == "wfp"


def test_contract_reasons_and_split(spark):
    rows = [variant(), variant(date="bad", price="x"), variant(market_id="12a")]
    cls = P.judged(text_rows(spark, rows))
    rej = Q.quarantine(cls).select("market_id", "reject_reasons").collect()
    assert sorted(tuple(r) for r in rej) == [
        ("12a", "market_id: failed cast to int"),
        ("639", "price_date: failed cast to date; price: failed cast to double"),
    ]
    good = Q.accepted(cls, P.TYPED_COLUMNS)
    assert good.count() == 1 and dict(good.dtypes)["price_date"] == "date"


def test_silver_flags_units_food_and_dedup(spark):
    rows = [
        variant(),
        variant(),  # exact duplicate
        variant(priceflag="actual,aggregate", unit="730 ML", price="730", category="non-food"),
        variant(priceflag=None, unit=None, commodity_id="7"),
        variant(unit=" 5 L ", commodity_id="8", price="1.005"),
    ]
    silver = P.silver_prices(text_rows(spark, rows))
    out = {r["commodity_id"]: r for r in silver.collect()}
    assert len(out) == 3 or len(out) == 4
    assert silver.count() == 4
    both = [r for r in silver.collect() if r["priceflag"] == "actual,aggregate"][0]
    assert both["is_actual"] and both["is_aggregate"] and both["unit_qty"] == 0.73 and both["unit_base"] == "L"
    assert both["price_per_base_unit"] == 1000.0 and both["is_food"] is False
    nulls = out[7]
    assert nulls["is_actual"] is None and nulls["unit_qty"] is None and nulls["price_per_base_unit"] is None
    five = out[8]
    assert five["unit"] == "5 L" and five["price_per_base_unit"] == 0.2


def test_unknown_units_are_rejects_and_all_are_named(spark, tmp_root):
    from medallion.plans.jobs import silver_price_job
    from medallion.sources.tables import NoSuchTableError, read_table

    many = [f"U{i:03d}" for i in range(150)]
    bronze = text_rows(spark, [variant(), variant(unit=None, commodity_id="3"), *[variant(unit=u) for u in many]])
    assert P.silver_prices(bronze).count() == 2
    assert {r["reject_reasons"] for r in P.rejects(bronze).collect()} == {"unit: not in its vocabulary"}
    with pytest.raises(Q.UnmappedValuesError) as e:
        silver_price_job(spark, bronze, tmp_root)
    assert str(e.value) == "unmapped unit values found in source: " + ", ".join(many)
    with pytest.raises(NoSuchTableError):
        read_table(spark, tmp_root, "silver.food_prices")
    # a row rejected for its types does not trip the gate
    ok = silver_price_job(spark, text_rows(spark, [variant(unit="SACK", price="x"), variant()]), tmp_root)
    assert ok["silver_rows"] == 1 and ok["rejects"]["rows"] == 1


def test_dedup_survivor_is_reproducible(spark):
    rows = [variant(price=str(p)) for p in (30, 10, 20)]
    for _ in range(2):
        s = P.silver_prices(text_rows(spark, rows)).collect()
        assert [r["price"] for r in s] == [10.0]


def test_dedup_audit_counts(spark):
    rows = [variant(), variant(), variant(price="bad"), variant(commodity_id="2")]
    a = P.dedup_audit(text_rows(spark, rows)).first().asDict()
    assert a == {"bronze_rows": 4, "rows_quarantined": 1, "rows_before_dedup": 3, "silver_rows": 2, "duplicates_removed": 1}


def test_lookup_missing_key_is_null(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    got = sorted(df.select(Q.lookup("k", {"a": 1.5}).alias("v")).collect(), key=lambda r: r["v"] is None)
    assert [r["v"] for r in got] == [1.5, None, None]


def test_dedup_in_ranges_equals_dedup_in_one_shuffle(spark):
    rows = [(None if i % 50 == 0 else i % 40, "hot" if i % 3 == 0 else f"k{i % 200}", i % 7, str(i % 11)) for i in range(3000)]
    rows += [(1, "hot", 0, "0")] * 500 + [(None, None, None, None)] * 20
    df = spark.createDataFrame(rows, "a int, b string, v int, w string").repartition(5)
    got = Q.dedup_in_ranges(df, ["a", "b"], ["v", "w"])
    want = Q.dedup(df, ["a", "b"], ["v", "w"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    spread = got.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.min("a").alias("lo"), F.max("a").alias("hi")).collect()
    bounds = sorted((r.lo, r.hi) for r in spread if r.lo is not None)
    assert all(x[1] <= y[0] for x, y in zip(bounds, bounds[1:]))


def test_the_silver_job_moves_rows_once(spark, tmp_root, monkeypatch):
    from medallion.plans import jobs
    from medallion.plans import prices as P
    from medallion.sources.testdata import price_rows

    seen = []
    real = jobs.write_version
    monkeypatch.setattr(jobs, "write_version", lambda df, *a, **k: seen.append((df, k)) or real(df, *a, **k))
    jobs.silver_price_job(spark, P.as_bronze_text(price_rows(spark, "/root/testdata/sf0.001")), tmp_root)
    plan, options = seen[0][0]._jdf.queryExecution().executedPlan().toString(), seen[0][1]
    wide = [line for line in plan.splitlines() if "Exchange" in line and "range" in line]
    assert options.get("dealt") and len(wide) == 1, plan
    assert plan.count("Exchange hashpartitioning") <= 1, plan  # that of the few often met keys
