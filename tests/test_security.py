from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changeflow.functions import session_rules
from changeflow.operators import security
from changeflow.sources.samples import EMPLOYEES_PER_STATE, seed_employees
from changeflow.sources.storage import new_folder

MASKS = {"tfn": "HR", "salary": "Finance"}


@pytest.mark.parametrize(("group", "rows"), [*EMPLOYEES_PER_STATE.items(), ("platform-admins", 20), ("HR", 0)])
def test_row_filter(spark, group, rows):
    assert security.row_filter(seed_employees(spark), "state", [group]).count() == rows


def test_no_groups_see_nothing(spark):
    assert security.row_filter(seed_employees(spark), "state", []).isEmpty()


def test_null_is_for_the_bypass_group_only(spark):
    one = spark.createDataFrame([(None,)], "state string")
    assert security.row_filter(one, "state", ["NSW"]).isEmpty()
    assert security.row_filter(one, "state", ["platform-admins"]).count() == 1


def values(df):
    return {r["tfn"] for r in df.collect()}, {r["salary"] for r in df.collect()}


def test_masks_follow_their_groups(spark):
    people = seed_employees(spark)
    for groups, text, number in [([], True, True), (["HR"], False, True), (["Finance"], True, False), (["HR", "Finance"], False, False), (["platform-admins"], True, True)]:
        tfn, salary = values(security.view_masked(people, "m", MASKS, groups))
        assert (tfn == {"XXX"}) is text
        assert (salary == {None}) is number
    masked = security.view_masked(people, "m", MASKS, [])
    assert masked.schema["salary"].dataType == people.schema["salary"].dataType
    with pytest.raises(TypeError):
        security.mask_text(people, "salary", [])
    with pytest.raises(TypeError):
        security.mask_number(people, "tfn", [])


def test_filter_comes_before_the_mask(spark):
    people = seed_employees(spark)
    got = security.secured(people, security.TableRules("state", {"state": "HR"}), ["NSW"])
    assert [r["state"] for r in got.collect()] == ["XXX"] * 4


def test_views(spark):
    people = seed_employees(spark)
    security.view_filtered(people, "v_filtered", "state", ["SA"])
    security.view_secured(people, "v_secured", "state", MASKS, ["SA", "Finance"])
    assert spark.sql("SELECT * FROM v_filtered").count() == 1
    secured = spark.sql("SELECT * FROM v_secured")
    assert values(secured)[0] == {"XXX"} and None not in values(secured)[1]


def test_tag_policies_cover_any_tagged_table(spark):
    people = seed_employees(spark)
    path = new_folder(spark, "tagged")
    people.write.parquet(path)
    stored = spark.read.parquet(path)
    assert security.column_tags(stored) == {"state": "state", "tfn": "pii", "salary": "financial"}
    got = security.apply_tag_policies(stored, security.STANDARD_POLICIES, ["QLD", "HR"])
    assert got.count() == 5 and values(got)[1] == {None} and "XXX" not in values(got)[0]
    plain = spark.range(3)
    assert security.apply_tag_policies(plain, security.STANDARD_POLICIES, []).count() == 3
    second = security.TagPolicy("again", "pii", "mask", "Legal")
    with pytest.raises(ValueError, match="masked by"):
        security.apply_tag_policies(people, [*security.STANDARD_POLICIES, second], [])


def test_session_functions_follow_the_reader(spark):
    seed_employees(spark).createOrReplaceTempView("session_people")
    session_rules.install(spark, ["NSW"])
    spark.sql(
        "CREATE OR REPLACE TEMPORARY VIEW session_secured AS SELECT state, cover_text(tfn, 'HR') AS tfn, "
        "cover_number(salary, 'Finance') AS salary FROM session_people WHERE row_visible(state)"
    )
    assert spark.table("session_secured").count() == 4
    session_rules.sign_in(spark, ["platform-admins", "HR"])
    rows = spark.table("session_secured")
    assert rows.count() == 20 and "XXX" not in values(rows)[0] and values(rows)[1] == {None}
    session_rules.sign_in(spark, [])
    assert spark.table("session_secured").isEmpty()


PRINCIPALS = [("nsw", "NSW"), ("two", "SA"), ("two", "WA"), ("root", "platform-admins"), ("adm", "admins"), ("adm", "NT"), ("hr", "HR")]


def test_verification_per_reader(spark):
    people = seed_employees(spark)
    readers = spark.createDataFrame(PRINCIPALS, "principal string, group_name string")
    seen = {r["principal"]: r["visible_rows"] for r in security.visible_rows(people, "state", readers).collect()}
    assert seen == {"nsw": 4, "two": 4, "root": 20, "adm": 2, "hr": 0}
    for principal in seen:
        groups = [g for p, g in PRINCIPALS if p == principal]
        assert security.row_filter(people, "state", groups).count() == seen[principal]
    expected = spark.createDataFrame([("nsw", 2), ("two", 4), ("root", 3)], "principal string, expected_rows bigint")
    got = {r["principal"]: (r["proves"], r["excess"]) for r in security.verify_row_filter(people, "state", readers, expected).collect()}
    assert got == {"nsw": (True, True), "two": (True, False), "root": (False, False), "adm": (False, False), "hr": (True, False)}
    one = security.verify_session_filter(security.row_filter(people, "state", ["NSW"]), ["NSW"], 2).first()
    assert (one["visible_rows"], one["proves"], one["excess"]) == (4, True, True)
    assert not security.is_test_reader(["NSW", "admins"]) and security.is_test_reader(["NSW"])
    members = {r["principal"]: r["bypass_groups"] for r in security.bypass_members(readers).collect()}
    assert members == {"root": ["platform-admins"], "adm": ["admins"]}
    semi = security.member_rows(people, "state", readers, "two")
    assert semi.count() == 4


def test_mask_leaks_are_counted(spark):
    people = seed_employees(spark)
    covered = security.view_masked(people, "m", MASKS, [])
    assert tuple(security.verify_column_mask(covered, "tfn").first()) == (20, 0)
    assert tuple(security.verify_column_mask(covered, "salary", None).first()) == (20, 0)
    leak = covered.unionByName(people.where("state = 'NT'"))
    assert tuple(security.verify_column_mask(leak, "tfn").first()) == (22, 2)


def test_coverage_shows_overlaps(spark):
    rules = {"people": security.TableRules("state")}
    rows = security.policy_coverage({"people": seed_employees(spark), "plain": spark.range(2)}, security.STANDARD_POLICIES, rules).collect()
    assert {(r["column_name"], r["mechanism"], r["covered_values"], r["overlap"]) for r in rows} == {
        ("state", "tag policy", 20, True), ("state", "table rule", 20, True),
        ("tfn", "tag policy", 20, False), ("salary", "tag policy", 20, False),
    }


def test_audit_trail(spark):
    log = spark.createDataFrame(
        [
            (datetime(2026, 1, 1), "catalog", "createPolicy", ("a@x",), {"name": "p1"}, (200,)),
            (datetime(2026, 1, 2), "catalog", "deletePolicy", ("b@x",), {"name": "p1"}, (403,)),
            (datetime(2026, 1, 3), "jobs", "createPolicy", ("c@x",), {"name": "p2"}, (200,)),
            (datetime(2026, 1, 4), "catalog", "getTable", ("d@x",), {}, (200,)),
        ],
        "event_time timestamp, service_name string, action_name string, user_identity struct<email:string>, "
        "request_params map<string,string>, response struct<status_code:int>",
    )
    got = security.policy_audit_trail(log, "catalog", ["createPolicy", "deletePolicy"]).collect()
    assert [(r["actor"], r["policy_name"], r["status_code"]) for r in got] == [("b@x", "p1", 403), ("a@x", "p1", 200)]


def test_filter_reaches_the_scan(spark):
    path = new_folder(spark, "secured")
    seed_employees(spark).write.parquet(path)
    rows = security.row_filter(spark.read.parquet(path), "state", ["NSW", "VIC"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(state, [NSW,VIC])]" in plan
