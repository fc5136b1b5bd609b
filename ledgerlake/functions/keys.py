"""Vault keys: lower-case hex MD5 over '|'-joined parts.

The part order and the tags are a contract with existing vault rows, so every
key in the library comes from the three functions here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

HUB_CUSTOMER = "HUB_CUSTOMER"
HUB_ACCOUNT = "HUB_ACCOUNT"
HUB_TRANSACTION = "HUB_TRANSACTION"
HUB_LOAN_CONTRACT = "HUB_LOAN_CONTRACT"
HUB_CC_CARD = "HUB_CC_CARD"
HUB_PRODUCT = "HUB_PRODUCT"
HUB_ORG = "HUB_ORG"

# Attributes whose change opens a new customer version (fixed values).
TRACKED_ATTRIBUTES = (
    "cust_name", "id_type", "id_no", "mobile", "cust_type", "cust_level", "gender", "status",
)


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def hub_key(source: str, business_id: str | Column, hub: str) -> Column:
    """Key of a business id; blanks around the id and null-versus-empty do not matter."""
    value = F.col(business_id) if isinstance(business_id, str) else business_id
    return F.md5(F.concat(F.lit(f"{source}|"), _text(F.trim(value)), F.lit(f"|{hub}")))


def link_key(left_key: Column, right_key: Column, rel_type: str, link: str) -> Column:
    """Key of a relation between two hub keys."""
    return F.md5(F.concat_ws("|", left_key, right_key, F.lit(rel_type), F.lit(link)))


def hash_diff(attributes: Iterable[str] = TRACKED_ATTRIBUTES) -> Column:
    """Fingerprint of the tracked attributes."""
    return F.md5(F.concat_ws("|", *[_text(F.col(a).cast("string")) for a in attributes]))
