"""What the optimizer makes of the operators: pushed filters, pruned columns, no Python, no products."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle import DATA
from strata.catalog import QUERIES, star
from strata.operators import clean as C
from strata.operators import joins as J
from strata.operators.graph import optionals
from strata.plans import analytics as A

SF = f"{DATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_row_products(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert not re.search(r"Python|CartesianProduct|InPandas|InArrow|ExistingRDD", text)
    # A nested-loop join may only meet a one-row side, which is an aggregate without keys.
    for kind in re.findall(r"BroadcastNestedLoopJoin (\w+) Build", text):
        assert kind in ("Cross", "Inner")
        assert "Keys: []" in text


def test_lists_are_pushed_into_the_dimension_scan(spark):
    text = plan(A.selective_star(star.gold_star(spark, SF), ["NATION_1", "NATION_2"], 2000))
    assert re.search(r"PushedFilters: .*In\(province_name, \[NATION_1,NATION_2\]\)", text)
    assert re.search(r"PushedFilters: .*EqualTo\(year,2000\)", text)
    fact = next(s for s in re.findall(r"ReadSchema: (.*)", text) if "gdp_current_price" in s)
    assert "population" not in fact and "gdp_constant_price" not in fact
    assert "BroadcastHashJoin" in text


def test_the_latest_year_prunes_the_folders_of_the_facts(spark):
    gold = star.stored_star(spark, SF)
    for query in (A.top_per_capita, A.density_ranking, lambda g: A.selective_star(g, ["NATION_0", "NATION_5"], 2000)):
        text = plan(query(gold))
        assert re.search(r"PartitionFilters: \[.*dynamicpruning", text)
    expected = {tuple(r) for r in A.band_averages(star.gold_star(spark, SF)).collect()}
    last = gold["dim_year"].orderBy(F.desc("year")).first()["year_id"]
    folders = {path.rsplit("/", 2)[0] for path in gold["fact_economics"].inputFiles()}
    assert len(folders) == 1
    years = sorted(pathlib.Path(folders.pop().removeprefix("file:").replace("///", "/")).glob("year_id=*"))
    assert len(years) == 7
    for year in years:  # no other year's files are opened
        if year.name != f"year_id={last}":
            for file in year.glob("*.parquet"):
                file.write_bytes(b"no table")
    assert {tuple(r) for r in A.band_averages(gold).collect()} == expected


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(A.top_per_capita(star.gold_star(spark, SF)))
    assert "TakeOrderedAndProject" in plan(A.density_ranking(star.gold_star(spark, SF)))


def test_keep_first_limits_each_key_before_the_shuffle(spark):
    events = star.table(spark, SF, "events")
    text = plan(C.keep_first(events, ["user_id"], [F.col("ts")]))
    assert text.count("WindowGroupLimit") >= 2
    tree = text.split("\n\n")[0]
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")


def test_the_order_range_reaches_the_scan(spark):
    text = plan(star.gdp(spark, SF))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(o_orderdate,1996-01-01", text)
    assert "o_orderpriority" not in text


def test_statistics_shrink_before_they_are_joined(spark):
    tree = plan(star.population(spark, SF)).split("\n\n")[0]
    scans = [line for line in tree.splitlines() if "Scan parquet" in line]
    assert len(scans) == 3
    assert re.search(r"partial|HashAggregate", tree) and tree.count("HashAggregate") == 4


def test_lag_is_computed_once(spark):
    text = plan(A.yoy_growth(star.gold_star(spark, SF), ["NATION_1"]))
    assert len(re.findall(r"lag\(gdp_current_price", text)) == 1


def test_a_hot_subject_is_split_in_every_join_of_a_chain(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.files.maxPartitionBytes": "64k",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        cold = spark.range(2000).select(F.concat(F.lit("s"), "id").alias("s"))
        hot = spark.range(0, 40000, 1, 8).select(
            F.lit("s1").alias("s"), F.lit("p1").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("o"), F.lit(None).cast("string").alias("lang"))
        rest = [cold.select("s", F.lit(p).alias("p"), F.concat(F.lit(p), "s").alias("o"), F.lit(None).cast("string").alias("lang")) for p in ("p2", "p3")]
        triples = hot.unionByName(rest[0]).unionByName(rest[1])
        found = optionals(cold, triples, {"a": ("p1", None), "b": ("p2", None), "c": ("p3", None)})
        assert len(found.collect()) == 40000 + 1999
        final = found._jdf.queryExecution().executedPlan().toString()
        assert final.split("Initial Plan")[0].count("skew=true") >= 3
    finally:
        for key in conf:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_large_sides_are_not_broadcast_by_hint(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, lines = star.table(spark, SF, "orders"), star.table(spark, SF, "lineitem")
        merged = J.outer_merge(orders.select(F.col("o_orderkey").alias("k"), "o_custkey"),
                               lines.select(F.col("l_orderkey").alias("k"), "l_partkey"), ["k"])
        assert "Broadcast" not in plan(merged)
        dim = star.table(spark, SF, "customer").select(F.col("c_custkey").alias("id"), F.lower("c_name").alias("n"))
        lookup = J.alias_lookup(dim, "id", ["n"], {})
        resolved = plan(J.resolve_names(orders.withColumn("n", F.col("o_orderpriority")), lookup, "n", "id"))
        assert "SortMergeJoin LeftOuter" in resolved
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
