"""All plans, built on the derived business tables, loaded into their targets and audited."""

import pytest

from checks.base import Star
from checks.crm import crm_tables
from checks.plan_queries import PARAMS
from siftload.plans import PLANS, UPSERT, run
from siftload.session import work_dir
from siftload.sinks.audit import RunAudit
from siftload.sinks.target import ParquetTarget

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def loaded(spark):
    star, base = Star(spark, FOLDER), work_dir(spark)
    names = {plan.target or key for key, plan in PLANS.items()} | {"contracts_distinct"}
    targets = {name: ParquetTarget(spark, f"{base}/{name}") for name in names}
    audit = RunAudit(spark, f"{base}/audit")
    counts = {key: run(plan, crm_tables(star, plan.sources), PARAMS, targets, audit) for key, plan in PLANS.items()}
    return star, targets, audit, counts


def test_every_plan_is_audited(loaded):
    _, _, audit, counts = loaded
    seen = {r["name"]: r["rows"] for r in audit.read().collect()}
    assert seen == counts and set(seen) == set(PLANS)
    assert all(n > 0 for n in counts.values())


@pytest.mark.parametrize("key", [k for k, p in PLANS.items() if not p.target])
def test_target_holds_the_extract_in_target_columns(loaded, key):
    _, targets, _, counts = loaded
    content = targets[key].read()
    plan = PLANS[key]
    assert {c.lower() for c in content.columns} == {c.lower() for c in (*plan.columns, *plan.unset)}
    if plan.mode != UPSERT:
        assert content.count() == counts[key]
    else:
        assert content.count() == content.select(*plan.keys).distinct().count() <= counts[key]


def test_users_are_set_on_projects(loaded):
    _, targets, _, counts = loaded
    projects = targets["projects"].read()
    assert projects.count() == counts["projects"]
    assert 0 < projects.where("USER_ICT_1 is not null").count() <= projects.count()


def test_derived_contracts(loaded):
    _, targets, _, _ = loaded
    derived = targets["contracts_distinct"].read()
    assert derived.count() == targets["contracts"].read().select(*derived.columns).distinct().count()


@pytest.mark.parametrize("key", ["status_history", "contracts", "pils_mobile"])
def test_a_second_run_changes_nothing(spark, loaded, key):
    star, targets, _, _ = loaded
    before = sorted(map(str, targets[key].read().collect()))
    plan = PLANS[key]
    plan.load(plan.build(crm_tables(star, plan.sources), PARAMS), targets, PARAMS)
    assert sorted(map(str, targets[key].read().collect())) == before
