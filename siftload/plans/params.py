"""What a run of the plans needs to be told: moments, cut-offs and the ids of one installation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # The moment "now" stands for; rolling windows count back from it.
    as_of: str

    # Cut-off dates.
    activities_from: str = "2020-03-13"
    appointments_from: str = "2019-01-01"
    contracts_from: str = "2023-01-01"
    final_calculations_from: str = "2019-01-01"
    fix_calculations_from: str = "2022-06-01"
    fixed_orders_from: str = "2019-07-01"
    mobile_orders_from: str = "2023-06-01"
    order_values_from: str = "2020-09-01"
    project_contracts_from: str = "2020-01-01"
    project_products_from: str = "2018-01-01"
    project_users_from: str = "2018-01-01"
    project_users_to: str = "2025-12-31"
    projects_from: str = "2019-01-01"
    verified_from_year: int = 2021
    # None takes the whole history, as loads by a mark do: they cut it themselves.
    history_days: int | None = 30
    last_calculation_days: int = 90

    # Ids of the installation. A plan names those it can't do without (NEEDS); ``run`` refuses to load without them.
    service_account: str = ""
    fix_category: str = ""
    mobile_category: str = ""
    service_kind_parameter: str = ""
    sites: Sequence[str] = ()
    campaign_creators: Sequence[str] = ()
    campaign_queues: Sequence[str] = ()
    campaign_callers_left_out: Sequence[str] = ()
    calculations_always_kept: Sequence[str] = ()
    potential_products: Sequence[str] = ()

    # True replaces the two hard-wired summer-time tables and fixed shifts by the rules of the zone.
    use_zone_rules: bool = False
    zone: str = "Europe/Warsaw"
