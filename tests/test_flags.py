"""Denylist checks: results and plan."""

from pyspark.sql import functions as F

from worklink.operators import flags
from worklink.sources.files import read_denylist


def test_phone_forms(spark, tmp_path):
    """A listed number is found as it is and behind a country prefix, also one longer than any phone."""
    long_number = "7" + "0123456789" * 3
    (tmp_path / "deny.txt").write_text(f"9876543210\n{long_number}\n  Bad@Example.org \nShady Works\n")
    deny = read_denylist(spark, str(tmp_path / "deny.txt"))
    phones = {"9876543210": 1, "+91 98765-43210": 1, "0919876543210": 1, "09876543210": 1, "9876543211": 0, "91": 1, "": 0,
              f"91{long_number}": 1, "0091 98765 43210": 1}
    rows = [(str(i), p, None) for i, p in enumerate(phones)] + [("e", None, " bad@example.ORG"), ("n", None, None)]
    df = spark.createDataFrame(rows, "id string, seeker_phone string, seeker_email string")
    found = {r.id: r.test_flag for r in flags.flag_application(df, deny).collect()}
    assert found == {str(i): hit for i, hit in enumerate(phones.values())} | {"e": 1, "n": 0}
    posts = spark.createDataFrame([("1", "shady works"), ("2", "Fine Works"), ("3", None)], "id string, organization_name string")
    assert {r.id: r.test_flag for r in flags.flag_posting(posts, deny).collect()} == {"1": 1, "2": 0, "3": 0}


def test_the_checked_table_is_not_shuffled(spark, tmp_path):
    (tmp_path / "deny.txt").write_text("\n".join(f"98765{i:05d}" for i in range(400)))
    path = str(tmp_path / "rows")
    spark.range(50_000).select(
        F.col("id").cast("string"), F.concat(F.lit("98765"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("seeker_phone"),
        F.lit("x@example.org").alias("seeker_email"), F.lit("KA").alias("state")).write.parquet(path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        flagged = flags.flag_application(spark.read.parquet(path), read_denylist(spark, str(tmp_path / "deny.txt")))
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert flagged.filter("test_flag = 1").count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_large_list_leaves_the_table_where_it_is(spark):
    """Filters and exact joins of the hits give what the joins give, and rows that meet nothing are not shuffled."""
    from worklink.operators.keyfilter import KeyFilter

    deny = spark.createDataFrame([("phone", f"98765{i:05d}") for i in range(300)] + [("email", "X@y.org")], "kind string, value string")
    rows = [(str(i), f"+91 98765{i * 7:05d}" if i % 3 else None, "x@Y.org" if i % 50 == 0 else f"m{i}@y.org") for i in range(1000)]
    table = spark.createDataFrame(rows, "id string, seeker_phone string, seeker_email string")
    filters = flags.denylist_filters(deny, 0)
    assert set(filters) == {"phone", "email", "org"} and all(isinstance(f, KeyFilter) for f in filters.values())
    assert flags.denylist_filters(deny) is None
    want = {r.id: r.test_flag for r in flags.flag_application(table, deny).collect()}
    got = {r.id: r.test_flag for r in flags.flag_application(table, deny, filters=filters).collect()}
    assert got == want and 0 < sum(want.values()) < len(want)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("1", "false")):
            spark.conf.set(k, v)
        clear = flags._split_by_filters(table.withColumn("_key_seeker_email", F.col("seeker_email")).withColumn("_key_seeker_phone", F.col("seeker_phone")),
                                        [("phone", "seeker_phone"), ("email", "seeker_email")], filters)[1]
        plan = clear._jdf.queryExecution().executedPlan().toString()
        # only the bitmaps of the list are exchanged, the table is scanned and filtered
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
        assert clear.count() >= 500
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
