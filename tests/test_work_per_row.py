"""What is computed for each row stays small: shared steps are bound once, however many tests look at them."""

from pyspark.sql import functions as F


def uses(df, name: str) -> int:
    """How often the optimised plan calls a function."""
    return df._jdf.queryExecution().optimizedPlan().toString().count(f"{name}(")


def test_deed_forms_are_made_once(spark):
    from ledgerloom.functions.property_codes import deed_type

    df = spark.createDataFrame([("QUIT CLAIM",), (None,), ("77 / Gift",), ("xx. other",), ("14",), ("K",)], "t string").select(deed_type(F.col("t")).alias("d"))
    assert [r[0] for r in df.collect()] == ["Quitclaim Deed", "Miscellaneous", "Gift Deed", "Miscellaneous", "Special Warranty Deed", "Miscellaneous"]
    assert uses(df, "regexp_replace") <= 4 and uses(df, "regexp_extract") <= 2


def test_a_licence_is_looked_for_once(spark):
    from ledgerloom.functions.permits import licence

    text = "Bo 7 OAK General Contractor x general CONTRACTOR CGC12 Master Mason 9"
    df = spark.createDataFrame([(text,), (None,), ("General",)], "t string").select(licence(F.col("t")).alias("x"))
    assert [r[0] and tuple(r[0]) for r in df.collect()] == [("general CONTRACTOR", "CGC12", "Bo 7 OAK General Contractor x"), None, None]
    assert uses(df, "array_join") <= 30


def test_small_files_are_parsed_on_all_cores(spark, sf):
    from ledgerloom.plans.tables import spread, table

    df = table(spark, sf, "customer")
    assert df.rdd.getNumPartitions() < 4 <= spread(df, "c_custkey").rdd.getNumPartitions()


def test_an_owner_is_read_once(spark):
    from ledgerloom.functions.owners import owner_list

    df = spark.createDataFrame([("SMITH JOHN A & MARY / Acme LLC and X",), (None,)], "t string").select(owner_list(F.col("t")).alias("x"))
    got = [[(o["kind"], o["first_name"], o["last_name"], o["company"]) for o in r[0] or []] for r in df.collect()]
    assert got == [[("person", "JOHN", "SMITH", None), ("person", "MARY", "SMITH", None), ("company", None, None, "Acme LLC"), ("person", "X", "SMITH", None)], []]
    assert uses(df, "split") <= 12


def test_cost_cards_and_portals_are_read_once(spark):
    from ledgerloom.functions.pages import cost_value, portal_candidates

    df = spark.createDataFrame([(["Land  Value", "x", "$3", "4", "MARKET VALUE", "9"], "A b"), (["x"], None), (None, "c")], "l array<string>, t string")
    df = df.select(cost_value(F.col("l"), "LAND VALUE").alias("v"), F.element_at(portal_candidates(F.col("t")), 2).alias("p"))
    assert [tuple(r) for r in df.collect()] == [(4.0, "https://a-b-egov.aspgov.com/Click2GovBP/"), (None, "https://permit-planner.unknown.org/"), (None, "https://permit-planner.c.org/")]
    assert uses(df, "regexp_replace") <= 15


def test_json_objects_are_told_without_their_schema(spark):
    from ledgerloom.functions.text import is_json_object
    from ledgerloom.operators.table_rows import appraisal_rows, permit_rows

    texts = ['{"a":1}', ' \n{"a":{}}', "[1]", "{bad", "5", '"{}"', "null", "", None, "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(is_json_object(F.col("t"))).collect()] == [True, True, False, False, False, False, False, False, False, True]
    rows, skipped = permit_rows(df.select(F.col("t").alias("record"), F.lit("u").alias("artifact_uri")))
    good, bad = appraisal_rows(df.select(F.lit("1").alias("request_identifier"), F.lit("property.json").alias("file_name"), F.col("t").alias("value")))
    assert all(uses(x, "schema_of_variant") + uses(x, "schemaOfVariant") + uses(x, "schemaofvariant") == 0 for x in (rows, skipped, good, bad))


def test_query_tokens_are_made_once(spark):
    from ledgerloom.functions.text import tokens_in_order

    df = spark.createDataFrame([("a c", "a b c"), ("c a", "a b c"), ("a a", "a b"), ("a", "a")], "q string, t string")
    df = df.select(tokens_in_order(F.split("q", " "), F.split("t", " ")).alias("x"))
    assert [r[0] for r in df.collect()] == [True, False, False, True]
    assert uses(df, "split") == 2
