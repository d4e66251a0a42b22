"""Domains, thresholds and rules as immutable values.

A file and the environment may change them, in that order: ``PIPELINE_CONFIG`` names the file, ``PIPELINE_STAGE`` the stage and
``OUTPUT_FILES`` the number of files of every table. Both are given to :func:`load_settings`, which nothing else reads.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from pathlib import Path

# The closed domains of the banking feed.
DOMAINS: dict[str, tuple[str, ...]] = {
    "transactions.transaction_type": ("CREDIT", "DEBIT", "FEE", "REVERSAL"),
    "transactions.channel": ("POS", "APP", "ATM", "EFT", "USSD", "INTERNAL"),
    "transactions.currency": ("ZAR",),
    "transactions.province": ("EASTERN CAPE", "FREE STATE", "GAUTENG", "KWAZULU-NATAL", "LIMPOPO", "MPUMALANGA", "NORTH WEST", "NORTHERN CAPE", "WESTERN CAPE"),
    "accounts.account_type": ("SAVINGS", "TRANSACTIONAL", "CREDIT"),
    "accounts.account_status": ("ACTIVE", "DORMANT", "CLOSED", "SUSPENDED"),
    "accounts.product_tier": ("BASIC", "STANDARD", "PREMIUM"),
    "accounts.digital_channel": ("APP", "USSD", "WEB"),
    "customers.gender": ("M", "F", "NB", "UNKNOWN"),
    "customers.province": ("EASTERN CAPE", "FREE STATE", "GAUTENG", "KWAZULU-NATAL", "LIMPOPO", "MPUMALANGA", "NORTH WEST", "NORTHERN CAPE", "WESTERN CAPE"),
    "customers.kyc_status": ("VERIFIED", "PENDING", "FAILED"),
}
#: Where a domain's column lies, if not at the table's top level.
COLUMN_PATHS = {"transactions.province": "location.province"}
# Boxes (latitude from, to, longitude from, to) of the country and its provinces.
COUNTRY_BOX = (-35.0, -22.0, 16.0, 33.5)
PROVINCE_BOXES: dict[str, tuple[float, float, float, float]] = {
    "EASTERN CAPE": (-34.5, -30.0, 22.0, 30.5),
    "FREE STATE": (-30.8, -26.5, 24.0, 29.8),
    "GAUTENG": (-26.9, -25.1, 27.0, 29.2),
    "KWAZULU-NATAL": (-31.3, -26.5, 28.5, 33.2),
    "LIMPOPO": (-25.7, -22.0, 26.0, 32.2),
    "MPUMALANGA": (-27.5, -24.3, 28.0, 32.4),
    "NORTH WEST": (-28.2, -24.5, 22.4, 28.5),
    "NORTHERN CAPE": (-32.8, -25.0, 16.0, 26.2),
    "WESTERN CAPE": (-34.9, -30.2, 17.5, 24.5),
}
# The home currency and the other ways to write it.
HOME_CURRENCY, CURRENCY_ALIASES = "ZAR", ("R", "RANDS", "710")
# The handling action that reports name for each issue.
ACTIONS = {
    "DUPLICATE_DEDUPED": "DEDUPLICATED_KEEP_FIRST",
    "ORPHANED_ACCOUNT": "QUARANTINED",
    "TYPE_MISMATCH": "CAST_TO_DECIMAL",
    "DATE_FORMAT": "NORMALISED_DATE",
    "CURRENCY_VARIANT": "NORMALISED_CURRENCY",
    "NULL_REQUIRED": "EXCLUDED_NULL_PK",
}
# The fields without which a transaction does not load, and the number of provinces a whole feed has.
REQUIRED_TRANSACTION_FIELDS = ("transaction_id", "account_id", "transaction_date", "transaction_timestamp", "amount", "transaction_type", "currency", "channel")

PROVINCES = len(PROVINCE_BOXES)


@dataclass(frozen=True)
class Settings:
    """Everything a run can vary. ``as_of`` replaces the current date, so that results can be repeated."""

    as_of: str = "2026-04-01"
    top_k: int = 5
    percentile_accuracy: int = 1_000_000
    extreme_amount: float = 50_000.0
    extreme_balance: float = 250_000.0
    repeat_pattern: int = 50
    high_cardinality: int = 50
    high_cardinality_ratio: float = 0.25
    domain_thresholds: dict[str, int] = field(default_factory=dict)
    recent_kept: int = 50
    bucket_bytes: int = 256 << 20
    most_buckets: int = 256
    profile_mode: str = "light"
    check_province_boxes: bool = True
    provinces: int = PROVINCES
    domains: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(DOMAINS))
    actions: dict[str, str] = field(default_factory=lambda: dict(ACTIONS))
    output_files: dict[str, int] = field(default_factory=dict)

    def files_for(self, table: str) -> int | None:
        """Configured number of output files of a table: the environment's (under the empty name), its own, its layer's
        (before the slash) or the default."""
        return self.output_files.get("") or self.output_files.get(table) or self.output_files.get(table.split("/")[0]) or self.output_files.get("default")


def load_settings(path: str | Path | None = None, env: Mapping[str, str] | None = None, **changes: object) -> Settings:
    """Settings from a JSON or YAML file (a missing file means the defaults), then the environment, then ``changes`` on top."""
    given: dict = {}
    env = os.environ if env is None else env
    path = path or env.get("PIPELINE_CONFIG")
    if path and Path(path).exists():
        text = Path(path).read_text()
        if str(path).endswith(".json"):
            given = json.loads(text)
        else:
            import yaml

            given = yaml.safe_load(text) or {}
    if "domains" in given:
        given["domains"] = DOMAINS | {k: tuple(v) for k, v in given["domains"].items()}
    if "OUTPUT_FILES" in env:
        given["output_files"] = {"": int(env["OUTPUT_FILES"])}
    return replace(Settings(), **(given | changes))


def infer_stage(env: Mapping[str, str] | None = None, stream_folder: str | Path | None = None, rules_file: str | Path | None = None) -> str:
    """The stage of a run: as the environment says, else 3 where stream files wait, 2 where there are rules, else 1."""
    said = (os.environ if env is None else env).get("PIPELINE_STAGE")
    if said in ("1", "2", "3"):
        return said
    if stream_folder and any(Path(stream_folder).glob("stream_*.jsonl")):
        return "3"
    return "2" if rules_file and Path(rules_file).exists() else "1"
