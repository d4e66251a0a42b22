"""SQL checks over the gold tables: volumes, unlinked accounts, provinces, flagged against clean."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrom.config import PROVINCES

_LINKED = "{accounts} a LEFT JOIN {customers} c ON a.customer_id = c.customer_id"


@dataclass(frozen=True)
class Check:
    """A grouped count over gold tables: what is read, by what it is grouped, and what is measured of each group."""

    source: str
    measures: str
    group: str | None = None
    where: str | None = None

    def sql(self) -> str:
        by = f"GROUP BY {self.group.split(' AS ')[0]} ORDER BY 1" if self.group else ""
        return f"SELECT {f'{self.group}, ' if self.group else ''}{self.measures} FROM {self.source} {f'WHERE {self.where}' if self.where else ''} {by}"


CHECKS = {
    "row_counts": " UNION ALL ".join(Check(f"{{{short}}}", f"'{name}' AS table_name, count(*) AS n").sql() for short, name in (("accounts", "dim_accounts"), ("customers", "dim_customers"), ("fact", "fact_transactions"))),
    "volume_by_type": Check("{fact}", "count(*) AS n, sum(amount) AS total, round(count(*) * 100.0D / sum(count(*)) OVER (), 2) AS pct", "transaction_type").sql(),
    "unlinked_accounts": Check(_LINKED, "count(*) AS n", where="c.customer_id IS NULL").sql(),
    "accounts_per_province": Check(_LINKED, "count(DISTINCT a.account_id) AS n", "c.province", "c.customer_id IS NOT NULL").sql(),
    "flagged_vs_clean": Check("{fact}", "count(*) AS n", "if(dq_flag IS NULL, 'clean', 'flagged') AS kind").sql(),
}


def check(name: str, fact: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    return fact.sparkSession.sql(CHECKS[name], fact=fact, accounts=accounts, customers=customers)


def failures(fact: DataFrame, accounts: DataFrame, customers: DataFrame, types: int = 4, provinces: int = PROVINCES) -> list[str]:
    """What is wrong with a finished run; empty if nothing is."""
    counts = {r["table_name"]: r["n"] for r in check("row_counts", fact, accounts, customers).collect()}
    found = [f"{t} is empty" for t, n in counts.items() if not n]
    if (n := check("volume_by_type", fact, accounts, customers).count()) != types:
        found.append(f"{n} transaction types, not {types}")
    if n := check("unlinked_accounts", fact, accounts, customers).first()["n"]:
        found.append(f"{n} unlinked accounts")
    named = check("accounts_per_province", fact, accounts, customers).select(F.upper(F.trim("province")).alias("p")).where("p <> ''")
    if (n := named.distinct().count()) != provinces:
        found.append(f"accounts in {n} provinces, not {provinces}")
    return found
