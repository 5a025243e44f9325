import datetime as dt

import pytest
from conftest import first_plan, listed
from pyspark.sql import functions as F

from lakehouse_kpis import Lakehouse
from lakehouse_kpis.catalog import Catalog
from lakehouse_kpis.functions.money import published
from lakehouse_kpis.governance.persona import SCHEMA, PersonaTable
from lakehouse_kpis.governance.policy import Identity
from lakehouse_kpis.governance.views import Governance
from lakehouse_kpis.operators.matview import MaterializedView, in_months, signature
from lakehouse_kpis.plans import questions
from lakehouse_kpis.session import shared_dir
from lakehouse_kpis.sources.landed import LandedTables
from lakehouse_kpis.sources.shapes import SHAPES
from lakehouse_kpis.sources.synthetic import SyntheticTables

KEYS = {
    "products": ["ITEMID"], "customers": ["ACCOUNTNUM"], "invoice_lines": ["INVOICEID", "LINENUM"],
    "markups": ["INVOICEID", "MARKUPCODE"], "legacy_headers": ["INVOICEID"],
    "gl": ["VOUCHER", "ACCOUNTNUM"], "employees": ["EMPLOYEE_ID"], "deals": ["DEAL_ID"],
    "sessions": ["SESSION_ID"],
}


@pytest.fixture(scope="module")
def made(spark):
    return SyntheticTables(spark, 0.02)


@pytest.fixture(scope="module")
def built(spark, made):
    lake = Lakehouse(spark, made, dt.date(2026, 4, 30))
    return lake.build(Catalog(spark, "t_"), invoice_buckets=4)


@pytest.mark.parametrize("name", list(KEYS))
def test_generated_keys_are_unique_and_stable(made, name):
    df = made.table(name)
    assert df.columns == list(SHAPES[name])
    assert df.count() == df.select(*KEYS[name]).distinct().count() > 0
    again = made.table(name).repartition(3)
    assert df.exceptAll(again).count() == 0


def test_build_and_read_back(spark, built):
    catalog, _ = Catalog(spark, "t_").open()
    assert catalog.read("silver", "dim_date").count() == 3652
    assert catalog.read("bronze", "dimension_values").count() == 6
    shown = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES t_bronze.customers").collect()}
    assert shown["contains_pii"] == "true" and shown["source_system"] == "D365_FO"
    spark.sql("CREATE DATABASE IF NOT EXISTS t_silver")
    for layer in ("bronze", "silver", "gold", "governance"):
        assert spark.catalog.databaseExists(f"t_{layer}")
    with pytest.raises(KeyError):
        catalog.read("tin", "x")


def test_stored_and_lazy_results_agree(spark, made, built):
    lazy = Lakehouse(spark, made, built.as_of)
    for question in (questions.revenue_by_system, questions.aging_by_territory,
                     questions.revenue_mix, questions.product_growth):
        assert listed(question(built)) == listed(question(lazy))


def test_months_prune_partitions(built):
    plan = first_plan(built.metrics.query(
        ["Source System"], ["Net Revenue"], where=[("Invoice Month", ">=", dt.date(2026, 3, 1))]))
    scan = plan[plan.index("PartitionFilters"):]
    assert "invoice_month" in scan[:200] and "PushedFilters" in scan
    plan = first_plan(questions.revenue_by_system(built, 3))
    assert "(invoice_month" in plan[plan.index("PartitionFilters"):][:200]


def test_bucketed_tables_join_without_a_shuffle(spark, built):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed = Lakehouse(spark, built.landed, built.as_of, spread=1)
        plan = first_plan(bucketed.table("fact_invoice_lines"))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_views_for_sql(spark, built):
    built.register_views(Catalog(spark, "t_"))
    got = spark.sql("SELECT c.territory, sum(a.outstanding_usd) s FROM vw_ar_aging a"
                    " JOIN dim_customer c USING (customer_key) GROUP BY 1")
    assert got.count() == 4


def test_landed_files(spark, made):
    path = f"{shared_dir(spark)}/landed"
    for name in ("customers", "deals"):
        made.table(name).write.mode("overwrite").json(f"{path}/{name}")
    back = LandedTables(spark, path, "json")
    for name in ("customers", "deals"):
        assert listed(back.table(name)) == listed(made.table(name))
    with pytest.raises(KeyError):
        back.table("unheard_of")


def test_incremental_refresh_equals_full(spark):
    jan, feb, mar = (dt.date(2024, m, 1) for m in (1, 2, 3))
    rows = {"all": [(jan, 1.0), (feb, 2.0), (feb, 3.0), (mar, 4.0)]}

    def define(months):
        df = spark.createDataFrame(rows["all"], "day date, v double")
        if months is not None:
            df = in_months(df, "day", months)
        return df.groupBy(F.trunc("day", "MONTH").alias("invoice_month")).agg(
            F.sum("v").alias("v"))

    view = MaterializedView(spark, f"{shared_dir(spark)}/view", define)
    view.refresh()
    assert listed(view.read(), "invoice_month", "v") == [(jan, 1.0), (feb, 5.0), (mar, 4.0)]
    rows["all"] = [(jan, 100.0), (feb, 7.0), (dt.date(2024, 4, 9), 1.0)]
    view.refresh([feb, mar])  # january changed too, but was not asked for; march is gone
    assert listed(view.read(), "invoice_month", "v") == [(jan, 1.0), (feb, 7.0)]
    view.refresh()
    assert listed(view.read(), "invoice_month", "v") == listed(define(None), "invoice_month", "v")
    view.refresh([])
    with pytest.raises(ValueError):
        view.refresh([dt.date(2024, 1, 15)])


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_view_without_rows_is_readable(spark, tmp_path):
    """After a refresh that yields nothing, and after the only month has been emptied."""
    month = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([(month, 1.0)], "invoice_month date, v double")
    held = {"now": rows.limit(0)}
    view = MaterializedView(spark, str(tmp_path / "mv"), lambda months: held["now"])
    view.refresh()
    assert view.read().count() == 0
    held["now"] = rows
    view.refresh([month])
    assert [tuple(r) for r in view.read().select("invoice_month", "v").collect()] == [(month, 1.0)]
    held["now"] = rows.limit(0)
    view.refresh([month])
    assert view.read().count() == 0


def test_a_view_finds_the_months_that_changed(spark, tmp_path):
    jan, feb, mar = dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5)
    shape = "day date, k string, v int"
    held = {"lines": [(jan, "a", 1), (feb, "a", 2), (feb, "b", 3), (mar, "a", 4)], "names": [("a", "A")]}
    asked = []

    def lines():
        return spark.createDataFrame(held["lines"], shape)

    def names():
        return spark.createDataFrame(held["names"], "k string, name string")

    def define(months):
        asked.append(months)
        rows = lines() if months is None else in_months(lines(), "day", months)
        return rows.join(names(), "k", "left").groupBy(
            F.trunc("day", "MONTH").alias("invoice_month"), "name").agg(F.sum("v").alias("v"))

    view = MaterializedView(spark, str(tmp_path / "mv"), define,
                            sources=lambda: {"lines": (lines(), "day"), "names": (names(), None)})

    def same():
        return listed(view.read(), "invoice_month", "name", "v") == listed(define(None))

    assert view.refresh() is None and same()
    assert view.refresh() == []  # nothing has changed
    held["lines"] = held["lines"][::-1]
    assert view.refresh() == []  # nor has it in another order
    held["lines"] = [(jan, "a", 1), (feb, "a", 2), (feb, "b", 9), (dt.date(2024, 4, 1), "a", 1)]
    asked.clear()
    assert view.refresh() == ["2024-02-01", "2024-03-01", "2024-04-01"]  # march is gone
    assert asked == [[dt.date(2024, m, 1) for m in (2, 3, 4)]] and same()
    held["names"] = [("a", "A"), ("b", "B")]
    assert view.refresh() is None and same()  # a dimension reaches every month
    held["lines"] = [*held["lines"], (None, "a", 5)]
    assert view.refresh() is None and same()
    held["lines"] = [(jan, "a", 1), (jan, "a", 1), *held["lines"][1:]]
    assert view.refresh() == ["2024-01-01"] and same()  # a copy of a row is a row


def test_a_null_that_moves_changes_the_signature(spark):
    shape = "day date, a int, b int"
    one = spark.createDataFrame([(None, 1, None)], shape)
    other = spark.createDataFrame([(None, None, 1)], shape)
    assert signature(one, "day") != signature(other, "day")
    assert signature(one.limit(0), "day") == {}


def test_a_reader_keeps_its_state_and_broken_refreshes_change_nothing(spark, tmp_path):
    month = dt.date(2024, 1, 1)
    held = {"v": 1.0}

    def define(months):
        if held["v"] is None:
            return spark.range(1).select(
                F.lit(month).alias("invoice_month"), F.raise_error("lost").cast("double").alias("v"))
        return spark.createDataFrame([(month, held["v"])], "invoice_month date, v double")

    view = MaterializedView(spark, str(tmp_path / "mv"), define)
    view.refresh()
    reader = view.read()
    held["v"] = 2.0
    view.refresh()
    assert reader.first()["v"] == 1.0 and view.read().first()["v"] == 2.0
    held["v"] = None
    with pytest.raises(Exception, match="lost"):
        view.refresh()
    held["v"] = 3.0
    assert view.read().first()["v"] == 2.0
    view.refresh()
    assert view.read().first()["v"] == 3.0
    # what only the first state read is gone
    assert len(list((tmp_path / "mv" / "states").glob("*.json"))) == 2


def test_personas_survive_a_broken_write(spark, tmp_path):
    table = PersonaTable(spark, str(tmp_path / "personas"))
    at = dt.datetime(2024, 1, 1)
    table.set("a@example.com", "HR", at)
    (tmp_path / "personas" / "version=000000002").mkdir()  # a write that never ended
    table.set("b@example.com", "FINANCE", at)
    assert table.read().count() == 2
    with pytest.raises(ValueError):
        table.change(spark.createDataFrame([("c", "NOPE", at)], SCHEMA))
    assert table.read().count() == 2


def small(spark, made, day=dt.date(2026, 4, 30)):
    return Lakehouse(spark, made, day)


def test_a_second_build_replaces_the_first(spark, made):
    catalog = Catalog(spark, "again_")
    small(spark, made).build(catalog)
    first = Lakehouse.open(catalog)
    lines = first.table("fact_invoice_lines").count()
    # from the tables of the first build, and with another date
    rebuilt = Lakehouse.open(catalog)
    rebuilt.as_of = dt.date(2026, 3, 31)
    rebuilt.stored = {}
    rebuilt._raw = {}
    second = rebuilt.build(catalog)
    assert catalog.current() == 2 and Lakehouse.open(catalog).as_of == dt.date(2026, 3, 31)
    assert second.table("fact_invoice_lines").count() == lines
    # whoever opened the first one reads on
    assert first.as_of == dt.date(2026, 4, 30) and first.table("fact_invoice_lines").count() == lines
    third = Lakehouse.open(catalog).build(catalog, keep=0)
    assert third.table("fact_invoice_lines").count() == lines
    assert not spark.catalog.databaseExists("again_silver__1")
    assert spark.table("again_gold.mv_sales_summary").columns == first.table("mv_sales_summary").columns


def test_a_broken_build_leaves_the_old_tables(spark, made, monkeypatch):
    catalog = Catalog(spark, "broken_")
    small(spark, made).build(catalog)
    customers = spark.table("broken_silver.dim_product").count()

    def fails(*_, **__):
        raise RuntimeError("lost")

    from lakehouse_kpis.operators import facts
    monkeypatch.setattr(facts, "fact_crm_deals", fails)
    with pytest.raises(RuntimeError):
        small(spark, made, dt.date(2025, 1, 1)).build(catalog)
    monkeypatch.undo()
    assert catalog.current() == 1 and spark.table("broken_silver.dim_product").count() == customers
    assert Lakehouse.open(catalog).as_of == dt.date(2026, 4, 30)
    small(spark, made).build(catalog)
    assert catalog.current() == 3  # the number of the broken one is not used again


def test_another_application_opens_the_last_build(spark, made):
    catalog = Catalog(spark, "other_")
    lake = small(spark, made).build(catalog, invoice_buckets=2)
    want = listed(questions.aging_by_territory(lake))
    for layer in ("bronze", "silver", "gold", "governance"):  # what a new in-memory catalog does not know
        for database in (f"other_{layer}", f"other_{layer}__1"):
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    opened = Lakehouse.open(Catalog(spark.newSession(), "other_", catalog.builds))
    assert listed(questions.aging_by_territory(opened)) == want
    assert "bucket" in spark.sql("SHOW CREATE TABLE other_bronze__1.markups").first()[0].lower() or (
        "CLUSTERED BY" in spark.sql("SHOW CREATE TABLE other_bronze__1.markups").first()[0])
    with pytest.raises(FileNotFoundError):
        Lakehouse.open(Catalog(spark, "never_"))


def test_published_tables_follow_the_reader(spark, made):
    catalog = Catalog(spark, "gov_")
    lake = small(spark, made).build(catalog)
    governance = Governance(catalog)
    me = spark.sql("SELECT current_user()").first()[0]
    raw = lake.table("dim_customer")
    employees = spark.table("gov_silver.dim_employee")
    at = dt.datetime(2026, 1, 1)

    def seen():
        return spark.table("gov_gold.vw_dim_customer")

    assert seen().count() == 0  # no persona, no row
    assert {r.ssn for r in employees.select("ssn").collect()} == {"XXX-XX-XXXX"}
    for i, persona in enumerate(["HR", "REGIONAL_MGR_US_EAST", "SALES_REP", "FINANCE"]):
        governance.set_persona(me, persona, at + dt.timedelta(minutes=i))
        reader = lake.read_as(Identity(me, persona))
        for table in ("dim_customer", "dim_employee", "fact_gl_transactions"):
            mine = spark.table(f"gov_silver.{table}")
            assert listed(mine) == listed(reader.table(table)), (persona, table)
        assert listed(seen()) == listed(reader.table("vw_dim_customer"))
        summary = published(reader.table("mv_sales_summary"))
        assert listed(spark.table("gov_gold.mv_sales_summary"), *summary.columns) == listed(summary)
        assert spark.table("gov_gold.vw_customer_360").count() == reader.table("vw_customer_360").count()
    assert raw.count() == seen().count()
    with pytest.raises(ValueError):
        governance.set_persona(me, "KING", at)
    governance.set_persona(me, "SALES_REP", at + dt.timedelta(hours=1))
    governance.add_members(spark.createDataFrame([(me, "us_west")], "user_email string, group_name string"))
    assert {r.territory for r in seen().collect()} == {"US-West"}
    governance.compact()
    assert spark.table("gov_governance.personas").count() == 1
    assert {r.territory for r in seen().collect()} == {"US-West"}


def test_legacy_lines_of_a_build_have_products(built):
    legacy = built.table("fact_invoice_lines").where("source_system = 'AX_2012'")
    known = built.table("dim_product").select("product_key")
    assert legacy.count() > 0 and legacy.join(known, "product_key", "left_anti").count() == 0
