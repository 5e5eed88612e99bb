"""Who belongs to a report: SKU, affiliate, region, product and exclusion filters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.functions.expr import in_or_null, not_in_or_null, not_true, unless

# Fixed values of the reports.
EXCLUDED_SKU = "HD"
EXCLUDED_REGIONS = ("China", "India")
EXCLUDED_TERRITORY = "Mid-West"
CLOSING_ACTIVITIES = ("End PrimaryReservation", "End CommitmentTerm", "Cancel PrimaryReservation")
UPLOAD_ERROR = "Renewal Contract Upload Error"
SUBLEASE = "Sublease Deal"
NOT_SUBLEASE = "Not Sublease Deal"
SALES_START = date(2019, 6, 1)
INVENTORY_START = date(2020, 1, 1)
EMAIL_START = date(2022, 1, 1)


@dataclass(frozen=True)
class Brand:
    """The operator's own name as it appears inside product values.

    Some product lists contain the company's name; it is configuration, not code.
    """

    name: str
    short: str

    @property
    def product_groupings(self) -> tuple[str, ...]:
        return (
            "SharedOfficeDesk",
            "Office",
            "DedicatedDesk",
            "PrivateAccessArea",
            f"HeadquartersBy{self.name.capitalize()}",
            f"HQx{self.short}",
            "office",
        )

    @property
    def membership_names(self) -> tuple[str, ...]:
        return ("All Access", f"{self.name} Anywhere Membership")

    @property
    def all_access_pattern(self) -> str:
        return f"%{self.name} All Access%"


def without_affiliates(spaces: DataFrame, accounts: DataFrame) -> DataFrame:
    """Drop spaces held by an affiliate; keep unknown and missing accounts.

    Only the affiliates' keys travel, as an anti join, instead of a left join on
    the (often NULL) account of every space. ``accounts`` has one row per account.
    """
    affiliates = accounts.filter("is_affiliate").select("account_uuid")
    return spaces.join(affiliates, "account_uuid", "left_anti")


def rentable_spaces(spaces: DataFrame, since: date | None = None) -> DataFrame:
    kept = spaces.filter(F.col("sku") != EXCLUDED_SKU)
    return kept if since is None else kept.filter(F.col("date") >= F.lit(since))


def active_spaces(spaces: DataFrame, accounts: DataFrame, since: date | None = None) -> DataFrame:
    """Shared population of every occupancy roll-up: rentable and not held by an affiliate."""
    return without_affiliates(rentable_spaces(spaces, since), accounts)


def reported_regions(locations: DataFrame) -> DataFrame:
    """Locations outside the excluded regions; an unknown region is excluded too."""
    return locations.filter(~F.col("region").isin(*EXCLUDED_REGIONS))


def reported_territories(locations: DataFrame) -> DataFrame:
    """Locations outside the excluded territory; an unknown territory is excluded too."""
    return locations.filter(F.col("territory") != EXCLUDED_TERRITORY)


def reported_sale(brand: Brand) -> Column:
    """Row test for the sales mart, on the columns of ``deals`` alone."""
    return (
        ~F.col("region").isin(*EXCLUDED_REGIONS)
        & (F.col("sales_reporting_month") >= F.lit(SALES_START))
        & in_or_null("product_grouping", brand.product_groupings)
        & ~F.col("reservation_deal_activity").isin(*CLOSING_ACTIVITIES)
        & not_in_or_null("reservable_name", brand.membership_names)
        & (F.col("product") != EXCLUDED_SKU)
        & not_true("is_affiliate")
    )


def keep_unless_reason(joined: DataFrame, found: Column, reason: str = UPLOAD_ERROR) -> DataFrame:
    """After a left join to the exclusion list: drop rows listed for ``reason``, keep all others."""
    return joined.filter(unless(found & (F.col("reason_for_exclusion") == reason)))
