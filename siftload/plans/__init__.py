"""The plans: each builds one extract from the source tables and says how its target is loaded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta
from importlib import import_module
from types import ModuleType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftload.plans.params import Params
from siftload.session import work_area
from siftload.sinks.audit import RunAudit
from siftload.sinks.incremental import rows_since, taken
from siftload.sinks.remote import Target
from siftload.sources.owned import all_owned
from siftload.sources.tables import Tables

FULL_REFRESH, REPLACE_WINDOW, UPSERT, KEYED_UPDATE = "full_refresh", "replace_window", "upsert", "keyed_update"


@dataclass(frozen=True)
class Plan:
    key: str
    mode: str = FULL_REFRESH
    target: str = ""
    keys: Sequence[str] = ()
    update: Sequence[str] | None = None
    insert_only: Sequence[str] = ()
    constants: Mapping[str, object] = field(default_factory=dict)
    derived: str = ""
    # Text columns of the target that another plan sets.
    unset: Sequence[str] = ()
    # Plans whose loads this one builds upon, besides the one whose target it sets columns of.
    after: Sequence[str] = ()

    @property
    def needed_first(self) -> Sequence[str]:
        return [*self.after, *([self.target] if self.target and self.target != self.key else [])]

    @property
    def module(self) -> ModuleType:
        return import_module(f"siftload.plans.{self.key}")

    @property
    def sources(self) -> Sequence[str]:
        return self.module.SOURCES

    @property
    def columns(self) -> Sequence[str]:
        return self.module.TARGET

    @property
    def needs(self) -> Sequence[str]:
        """Params without which the extract would be empty or incomplete."""
        return getattr(self.module, "NEEDS", ())

    @property
    def by_owner(self) -> Sequence[str]:
        """Attribute tables that the plan asks for the rows of some owners."""
        return getattr(self.module, "BY_OWNER", ())

    def check(self, params: Params) -> None:
        missing = [name for name in self.needs if not getattr(params, name)]
        if missing:
            raise ValueError(f"plan {self.key} needs params {missing}")

    def build(self, tables: Tables, params: Params) -> DataFrame:
        return self.module.build(tables, params)

    def load(self, df: DataFrame, targets: Mapping[str, Target], params: Params) -> None:
        target = targets[self.target or self.key]
        if self.mode == REPLACE_WINDOW:
            target.replace_window(df, self.module.window(params))
        elif self.mode == UPSERT:
            target.merge(df, self.keys, update=self.update, insert_only=self.insert_only, constants=self.constants)
        elif self.mode == KEYED_UPDATE:
            target.update(df, self.keys, self.update)
        else:
            target.full_refresh(df.withColumns({name: F.lit(None).cast("string") for name in self.unset}))
        if self.derived:
            targets[self.derived].refresh_from(target, self.module.DERIVED)


def _activity_plan(key: str) -> Plan:
    m = import_module(f"siftload.plans.{key}")
    return Plan(key, UPSERT, keys=m.KEYS, update=m.UPDATE, insert_only=m.INSERT_ONLY, constants=m.CONSTANTS)


USER_COLUMNS = ["USER_ICT_1", "USER_ICT_2", "USER_ICT_3", "USER_ICT_4"]

# In run order: project users are set on the loaded projects.
PLANS: dict[str, Plan] = {
    plan.key: plan
    for plan in (
        Plan("pils_mobile", REPLACE_WINDOW),
        Plan("pils_fix"),
        Plan("pils_values"),
        Plan("pils_parameters"),
        Plan("contacts", UPSERT, keys=["ID"]),
        _activity_plan("phone_calls"),
        _activity_plan("appointments"),
        Plan("contracts", derived="contracts_distinct"),
        Plan("projects", unset=USER_COLUMNS),
        Plan("project_users", KEYED_UPDATE, target="projects", keys=["PROJECT_NUMBER"], update=USER_COLUMNS),
        Plan("project_products"),
        Plan("project_product_params"),
        Plan("projects_contracts"),
        Plan("status_history", UPSERT, keys=["id"]),
        Plan("fix_orders"),
        Plan("fix_orders_value"),
        Plan("potential"),
        Plan("project_last_pils"),
        Plan("campaigns"),
        Plan("order_progress"),
        Plan("e_contracts"),
    )
}


def run(plan: Plan, tables: Tables, params: Params, targets: Mapping[str, Target], audit: RunAudit) -> int:
    """One audited load; returns the rows written. Its intermediate tables are removed afterwards.

    Params that the plan needs are checked before anything is built or any target is touched.
    """
    plan.check(params)
    with work_area(audit.spark):
        return audit.run(plan.key, lambda: plan.build(tables, params), lambda df: plan.load(df, targets, params))


# Attribute tables that several plans ask for the rows of some owners.
OWNERS = {"pl_parameter": "elob_pl_resultid"}

DONE, SKIPPED, FAILED, NOT_STARTED = "done", "skipped", "failed", "not started"


def run_all(
    plans: Mapping[str, Plan], tables: Tables, params: Params, targets: Mapping[str, Target], audit: RunAudit
) -> dict[str, str]:
    """Loads plans in order and says what became of each.

    Plans that the audit's run has finished before are skipped, so a run that stopped is taken up where it was. A plan that
    fails is audited and does not stop the others, but those that build upon it, or upon one not started, are not started.
    A plan named by another and not among ``plans`` counts as loaded. Missing params of any plan stop the run before its first load.
    An attribute table of ``OWNERS`` that two or more of the plans still to come read is laid out by owner first.
    """
    finished = audit.finished()
    ahead = [plan for key, plan in plans.items() if key not in finished]
    for plan in ahead:
        plan.check(params)
    shared = {name: (tables[name], owner) for name, owner in OWNERS.items() if sum(name in plan.by_owner for plan in ahead) > 1}
    with work_area(audit.spark), all_owned(shared) as owned:
        return _run_each(plans, tables.with_owned(owned), params, targets, audit, finished)


def _run_each(plans, tables, params, targets, audit, finished) -> dict[str, str]:
    became: dict[str, str] = {}
    for key, plan in plans.items():
        if key in finished:
            became[key] = SKIPPED
        elif any(became.get(k, DONE if k not in plans else NOT_STARTED) in (FAILED, NOT_STARTED) for k in plan.needed_first):
            became[key] = NOT_STARTED
            audit.message(key, "not started: a plan it builds upon was not loaded")
        else:
            try:
                run(plan, tables, params, targets, audit)
                became[key] = DONE
            except Exception:  # audited by run; what does not depend on it goes on
                became[key] = FAILED
    return became


def run_increment(
    plan: Plan, tables: Tables, params: Params, targets: Mapping[str, Target], audit: RunAudit, overlap: timedelta = timedelta(days=7)
) -> int:
    """One audited upsert of what changed in the plan's marked source since its last such load, less ``overlap``.

    The first one takes everything. Of the other sources only what the taken rows join with is read, as in any load.
    """
    plan.check(params)
    if plan.mode != UPSERT or not hasattr(plan.module, "MARK"):
        raise ValueError(f"plan {plan.key} does not load by a mark")
    source, column = plan.module.MARK
    name, target, whole = f"{source}.{column}", targets[plan.target or plan.key], replace(params, history_days=None)
    with work_area(audit.spark):
        mark = target.marks().get(name)
        rows, reached = taken(rows_since(tables[source], column, mark, overlap), column, mark)
        how = {"update": plan.update, "insert_only": plan.insert_only, "constants": plan.constants, "marks": {name: reached}}
        return audit.run(plan.key, lambda: plan.build(tables.replaced(source, rows), whole), lambda df: target.merge(df, plan.keys, **how))
