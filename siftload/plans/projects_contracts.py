"""Numbers of projects and contracts that belong together."""

from pyspark.sql import DataFrame

from siftload.functions import dates
from siftload.plans.common import c
from siftload.plans.params import Params
from siftload.sources.tables import Tables

SOURCES = ("contract_opportunity", "opportunity", "contract")
TARGET = ["PROJECT_NUMBER", "CONTRACT_NUMBER"]


def build(t: Tables, p: Params) -> DataFrame:
    projects = (
        t["opportunity"]
        .where(c("createdon") >= dates.ntz(p.project_contracts_from))
        .select("opportunityid", c("elob_opportunityid").alias("PROJECT_NUMBER"))
    )
    contracts = t["contract"].select("contractid", c("contractnumber").alias("CONTRACT_NUMBER"))
    links = t["contract_opportunity"].select("opportunityid", "contractid")
    return links.join(projects, "opportunityid").join(contracts, "contractid").select(*TARGET)
