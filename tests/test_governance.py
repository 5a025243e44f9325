import datetime as dt

import pytest
from conftest import SMALL, first_plan, listed

from lakehouse_kpis.governance import persona, sql_functions
from lakehouse_kpis.governance.policy import (
    GROUP_POLICY, PERSONA_POLICY, Identity, groups_of, secure, user_privileges, visible_rows,
)
from lakehouse_kpis.session import shared_dir
from lakehouse_kpis.sources.fixed import PERSONAS

AT = dt.datetime(2024, 1, 1, 12)


@pytest.fixture(scope="module")
def customers(spark):
    places = ["US-East", "US-West", "Canada-East", "Canada-West", None, "Mexico"]
    rows = [(f"C{i}", f"a{i}@b.com", "+1-555-0100-1736", "1 Oak St", p)
            for i, p in enumerate(places)]
    return spark.createDataFrame(
        rows, "customer_key string, email string, phone string, address_line1 string,"
              " territory string")


def read(customers, persona_name=None, groups=(), policy=PERSONA_POLICY):
    who = Identity("u@example.com", persona_name, frozenset(groups))
    return secure(customers, "dim_customer", policy.privileges(who))


@pytest.mark.parametrize("name, rows, email, phone, address", [
    ("GLOBAL_LEADERSHIP", 6, True, True, True),
    ("HR", 6, True, True, True),
    ("FINANCE", 6, True, False, True),
    ("SALES_LEADER", 6, False, True, False),
    ("SALES_REP", 0, False, False, False),
    ("REGIONAL_MGR_US_EAST", 1, False, False, False),
    ("REGIONAL_MGR_US_WEST", 1, False, False, False),
    ("REGIONAL_MGR_CA_EAST", 1, False, False, False),
    ("REGIONAL_MGR_CA_WEST", 1, False, False, False),
    (None, 0, False, False, False),
    ("SOMEBODY", 0, False, False, False),
])
def test_persona_matrix(customers, name, rows, email, phone, address):
    seen = read(customers, name).collect()
    assert len(seen) == rows
    for r in seen:
        assert (r.email == f"a{r.customer_key[1:]}@b.com") is email
        assert (r.phone == "+1-555-0100-1736") is phone
        assert (r.address_line1 == "1 Oak St") is address


def test_employee_masks(spark):
    staff = spark.createDataFrame([("E1", "123-45-6789", 10.0)],
                                  "employee_key string, ssn string, annual_salary_usd double")

    def seen(name):
        held = PERSONA_POLICY.privileges(Identity("u", name))
        return tuple(secure(staff, "dim_employee", held).first())[1:]

    assert seen("HR") == ("123-45-6789", 10.0)
    assert seen("FINANCE") == ("XXX-XX-XXXX", 10.0)
    assert seen("GLOBAL_LEADERSHIP") == ("XXX-XX-XXXX", None)


def test_groups_count_beside_the_persona(customers):
    assert listed(read(customers, None, ["canada_west"]), "territory") == [("Canada-West",)]
    both = read(customers, "REGIONAL_MGR_US_EAST", ["canada_west", "hr"]).collect()
    assert sorted(r.territory for r in both) == ["Canada-West", "US-East"]
    assert all(not r.email.startswith("***") for r in both)


def test_policies_are_data(customers):
    assert read(customers, "HR", policy=GROUP_POLICY).count() == 0
    assert read(customers, None, ["admins"], GROUP_POLICY).count() == 6
    assert read(customers, None, ["admins"]).count() == 0


def test_readers_work_on_masked_values(customers):
    seen = read(customers, "SALES_LEADER")
    assert seen.filter("email = 'a1@b.com'").count() == 0
    assert seen.filter("email = '***@b.com'").count() == 6
    assert listed(seen.groupBy("email").count()) == [("***@b.com", 6)]


def test_a_privileged_plan_has_no_mask(customers):
    plan = first_plan(read(customers, "GLOBAL_LEADERSHIP"))
    assert "***" not in plan and "REDACTED" not in plan and "Filter" not in plan


def test_unknown_territory_is_hidden(customers):
    own = visible_rows(customers, {"rows:US-East", "rows:US-West"})
    assert listed(own, "territory") == [("US-East",), ("US-West",)]


def test_everything_above_is_governed(lake):
    east = lake.read_as(Identity("u", "REGIONAL_MGR_US_EAST"))
    for name in ("mv_sales_summary", "vw_customer_360", "vw_finance_kpis", "ar", "invoices"):
        assert {r[0] for r in east.table(name).select("territory").distinct().collect()} == {
            "US-East"}
    # left joins keep the facts and lose the hidden dimension values
    whole = lake.metrics.query([], ["Line Count"]).first()[0]
    parts = dict(listed(east.metrics.query(["Territory"], ["Line Count"])))
    assert set(parts) == {"US-East", None} and sum(parts.values()) == whole
    # the owner's frames are untouched
    assert lake.table("dim_customer").select("territory").distinct().count() > 1


def test_masking_keeps_the_rows(lake):
    seen = lake.read_as(Identity("u", "SALES_LEADER")).table("dim_customer")
    assert seen.count() == lake.table("dim_customer").count()


@pytest.fixture(scope="module")
def table(spark):
    rows = [("a", "HR", AT), ("a", "FINANCE", AT + dt.timedelta(days=1)),
            ("b", "SALES_REP", AT), ("c", "INTERN", AT), ("d", "HR", AT), ("d", "FINANCE", AT)]
    return spark.createDataFrame(rows, "user_email string, persona string, set_at timestamp_ntz")


def test_newest_persona_counts(table):
    assert listed(persona.active(table), "user_email", "persona") == [
        ("a", "FINANCE"), ("b", "SALES_REP"), ("c", "INTERN"), ("d", "HR")]
    assert persona.identify(table, "a").persona == "FINANCE"
    assert persona.identify(table, "nobody").persona is None
    assert PERSONA_POLICY.privileges(persona.identify(table, "nobody")) == frozenset()


def test_set_persona(table):
    later = dt.datetime(2025, 1, 1)
    once = persona.set_persona(table, "a", "HR", later)
    twice = persona.set_persona(once, "a", "HR", later)
    for got in (once, twice):
        assert listed(got.filter("user_email = 'a'")) == [("a", "HR", later)]
        assert got.count() == 5
    assert persona.set_persona(table, "new", "HR", later).count() == 7
    with pytest.raises(ValueError):
        persona.set_persona(table, "a", "INTERN", later)


def test_invalid_personas(table):
    assert listed(persona.invalid_rows(table), "user_email", "persona") == [("c", "INTERN")]
    assert len(PERSONAS) == 9 and len(persona.SCHEMA) == 3


def test_user_privileges(spark):
    directory = spark.createDataFrame(
        [("a", "hr"), ("a", "hr"), ("a", "us_east"), ("b", "nobody")],
        "user_email string, group_name string")
    got = listed(user_privileges(directory, PERSONA_POLICY))
    assert got == sorted(
        [("a", f"see:{c}") for c in ("email", "phone", "address", "ssn", "salary")]
        + [("a", "rows:US-East")], key=repr)


def test_a_reader_resolved_from_tables(spark, table, customers):
    directory = spark.createDataFrame(
        [("b", "canada_east"), ("b", "canada_east"), ("b", "chess_club"), ("a", "hr")],
        "user_email string, group_name string")
    groups = groups_of(directory, PERSONA_POLICY, "b")
    assert groups == {"canada_east"}
    who = persona.identify(table, "b", groups)
    assert who == Identity("b", "SALES_REP", frozenset({"canada_east"}))
    seen = secure(customers, "dim_customer", PERSONA_POLICY.privileges(who))
    assert listed(seen, "territory", "phone") == [("Canada-East", "***-***-1736")]


def test_sql_functions(spark, customers):
    customers.createOrReplaceTempView("raw_customers")
    query = ("SELECT mask_email(email) e, mask_phone(phone) p, mask_address(address_line1) a,"
             " mask_ssn('1') s, mask_salary(1D) m FROM raw_customers"
             " WHERE row_filter_territory(territory)")
    sql_functions.register(spark, PERSONA_POLICY, Identity("u", "REGIONAL_MGR_US_WEST"))
    assert listed(spark.sql(query)) == [
        ("***@b.com", "***-***-1736", "[REDACTED]", "XXX-XX-XXXX", None)]
    sql_functions.register(spark, PERSONA_POLICY, Identity("u", "HR"))
    assert spark.sql(query).count() == 6
    sql_functions.register(spark, PERSONA_POLICY, Identity("u", "SALES_REP"))
    assert spark.sql(query).count() == 0


def test_as_many_personas_as_the_table_says(spark):
    import __spark_entry__ as entry

    got = entry.queries()["gov_matrix"](spark, SMALL)
    assert sorted(r.persona for r in got.collect()) == sorted(PERSONAS)


def test_active_persona_in_sql(spark, table):
    table.createOrReplaceTempView("persona_rows")
    for user, name in (("a", "FINANCE"), ("nobody", None)):
        sql_functions.register_active_persona(spark, "persona_rows", user)
        assert spark.sql("SELECT active_persona()").first()[0] == name
    sql_functions.register_active_persona(spark, "persona_rows")
    assert spark.sql("SELECT active_persona()").first()[0] is None


def test_persona_table_versions(spark):
    stored = persona.PersonaTable(spark, f"{shared_dir(spark)}/personas")
    assert stored.read().count() == 0
    stored.set("a", "HR", AT)
    stored.set("b", "SALES_REP", AT)
    stored.set("a", "FINANCE", AT)  # set again: the old row goes, whatever its time
    assert listed(stored.read()) == [("a", "FINANCE", AT), ("b", "SALES_REP", AT)]
    with pytest.raises(ValueError):
        stored.set("a", "INTERN", AT)
    stored.change(spark.createDataFrame(
        [("b", "HR", AT), ("c", "HR", AT)], "user_email string, persona string, set_at timestamp_ntz"))
    assert listed(stored.read(), "user_email", "persona") == [
        ("a", "FINANCE"), ("b", "HR"), ("c", "HR")]
    assert persona.identify(stored.read(), "c") == Identity("c", "HR")
