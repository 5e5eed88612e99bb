"""Role views over the TPC-H-like test tables.

Each view is plain SQL that Spark and DuckDB both accept; ``{table}`` stands for
a base table. The views inject the NULLs, duplicates, renamed buildings, open
intervals and overlapping versions that the base tables lack. All dates move
forward by 24 years so that the fixed calendar cut-offs of the operators fall
inside the data. A snapshot row is a lineitem, a sale is one (order, line).
"""

from __future__ import annotations

import os
import re
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmart.operators.sizing import BROADCAST_ROWS, materialize, release, scratch
from deskmart.sources.roles import Roles

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents")


def _month(ts: str) -> str:
    return f"make_date(cast(year({ts}) as int) + 24, cast(month({ts}) as int), 1)"


def _day(ts: str) -> str:
    return f"cast(cast({ts} as date) + interval '24' year as date)"


def _id(prefix: str, key: str) -> str:
    return f"'{prefix}' || cast({key} as string)"


_RESERVATION = "'R' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)"
_LOCATION_REGION = "case when n_nationkey % 9 = 8 then 'China' else r_name end"
_TERRITORY = (
    "case when n_nationkey % 7 = 0 then null when n_nationkey % 11 = 10 then 'Mid-West' "
    "else r_name || '-' || cast(n_nationkey % 3 as string) end"
)
_SKU = "case p_type when 'PROMO' then 'HD' when 'SMALL' then 'DD' else p_type end"
_TERM = (
    "case when l_linestatus = 'F' then null when l_partkey % 53 = 0 then '422971' "
    "else cast(l_partkey % 3 as string) end"
)
# Commitment start: the month after the sale, but before it for every sixth order.
_START = (
    f"cast(case when l_orderkey % 6 = 0 then {_month('o_orderdate')} - interval '1' month "
    f"else {_month('o_orderdate')} + interval '1' month end as date)"
)
_END = f"cast({_START} + interval '1' month * (cast(l_linenumber as int) * 6) as date)"
_BASE_PRICE = "(100 + l_orderkey % 50)"

ROLE_SQL: dict[str, str] = {
    "locations": f"""
        select {_id('L', 'n_nationkey')} as uuid, {_LOCATION_REGION} as region,
          {_TERRITORY} as territory, {_id('C', 'n_regionkey')} as country,
          case when n_nationkey % 2 = 0 then 'even' else 'odd' end as market,
          {_id('W', 'n_nationkey')} as ww_code,
          case when n_nationkey % 6 = 5 then null else {_id('B', 'n_nationkey')} end as building_code
        from {{nation}} join {{region}} on n_regionkey = r_regionkey""",
    "accounts": f"""
        select {_id('A', 'c_custkey')} as account_uuid,
          case c_mktsegment when 'MACHINERY' then true when 'BUILDING' then null else false end
            as is_affiliate
        from {{customer}}""",
    "reservables": f"""
        select {_id('P', 'p_partkey')} as uuid,
          case when p_partkey % 11 = 0 then null else {_id('F', 'p_size')} end as floor_uuid
        from {{part}}""",
    "spaces": f"""
        select {_month('l_shipdate')} as date, {_month('l_shipdate')} as report_month,
          {_id('L', 's_nationkey')} as location_uuid,
          case when s_nationkey = 3 and l_shipdate >= timestamp '1999-05-01 00:00:00'
            then 'Building 3 (new)' else {_id('Building ', 's_nationkey')} end as location_name,
          {_id('P', 'l_partkey')} as reservable_uuid, p_name as reservable_name,
          p_brand as reservable_type,
          case when l_linenumber = 7 then null else {_RESERVATION} end as reservation_uuid,
          case when l_linenumber = 7 then null else {_id('A', 'o_custkey')} end as account_uuid,
          case when l_linenumber = 7 then null else {_id('Customer ', 'o_custkey')} end as account_name,
          {_SKU} as sku,
          case when l_returnflag = 'N' then 0 else cast(l_quantity as bigint) end as occupancy,
          case when l_partkey % 97 = 0 then null else cast(p_size as bigint) end as capacity,
          {_TERM} as term_id, l_linestatus = 'F' as is_month_to_month,
          case when l_linenumber = 6 then null else cast(l_linenumber as int) * 6 end
            as commitment_full_duration,
          cast(l_linenumber * 6 - l_partkey % 3 as int) as commitment_remaining_duration,
          case when l_returnflag = 'R' then null else l_shipdate + interval '24' year end
            as commitment_term_created_utc,
          {_START} as commitment_term_start_utc, {_END} as commitment_term_end_utc,
          case when l_suppkey % 4 = 0 then cast({_START} - interval '1' day as date)
            else {_START} end as commitment_term_start_local,
          case when l_suppkey % 4 = 0 then cast({_END} - interval '1' day as date)
            else {_END} end as commitment_term_end_local,
          case when l_partkey % 19 = 0 then l_shipdate + interval '24' year end
            as commitment_term_cancelled_utc,
          case l_suppkey % 14 when 0 then 'GROWWITHUS' when 1 then 'X-Q3SPACEPROMO-Y'
            when 2 then 'Q4SPACEPROMO' when 3 then '100HARRIS' when 4 then 'X100HARRIS Y'
            when 5 then '100HARRIS4P' when 6 then 'UNKNOWN' when 7 then 'SEAGROWTHCAMPUS'
            when 8 then 'SSQBADAPPLE' when 9 then 'NEW-NORMAL' when 10 then 'M2MUPGRADE'
            end as applied_discount,
          {_id('CUR', 's_nationkey % 5')} as local_currency,
          cast(round(l_extendedprice) as decimal(18,2)) as usd_price,
          cast(round(l_extendedprice) * (1 + s_nationkey % 5) as decimal(18,2)) as local_currency_price,
          cast(round(l_extendedprice) * (1 + s_nationkey % 5) + 1 as decimal(18,2)) as market_price_local,
          cast(round(l_extendedprice) + 1 as decimal(18,2)) as market_price_usd,
          cast(round(l_extendedprice) - l_linenumber as decimal(18,2)) as net_paid_price_usd,
          cast(round(l_extendedprice) * (1 + s_nationkey % 5) - l_linenumber as decimal(18,2))
            as net_paid_price_local,
          l_returnflag as snapshot_status
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
          join {{supplier}} on l_suppkey = s_suppkey join {{part}} on l_partkey = p_partkey""",
    "deals": f"""
        select {_month('o_orderdate')} as sales_reporting_month,
          case when l_orderkey % 31 = 7 then null else {_id('D', 'l_orderkey')} end as deal_uuid,
          case when (l_orderkey + l_linenumber) % 17 = 3 then null else {_RESERVATION} end as primary_reservation_uuid,
          case when l_orderkey % 13 = 0 then null else {_id('O', 'l_orderkey')} end
            as salesforce_opportunity_id,
          {_id('P', 'l_partkey')} as reservable_uuid, {_id('L', 's_nationkey')} as location_uuid,
          {_day('o_orderdate')} as initial_sale_date,
          {_day('o_orderdate')} as reservation_start_date,
          cast({_day('o_orderdate')} + interval '3' year as date) as reservation_end_date,
          case when l_linenumber = 5 then null else {_START} end as resulting_commitment_term_start,
          case when l_linenumber = 5 then null else {_END} end as resulting_commitment_term_end,
          months as resulting_commitment_term_months,
          {_LOCATION_REGION} as region,
          case when n_nationkey = 6 then 'Israel' else r_name end as subregion,
          {_TERRITORY} as territory, {_id('SM', 'n_nationkey % 4')} as sales_market,
          {_id('City ', 'n_nationkey')} as city, {_id('Building ', 's_nationkey')} as location_name,
          o_orderpriority as deal_type,
          case when o_orderstatus = 'P' and l_linenumber = 4 then 'End PrimaryReservation'
            when o_orderstatus = 'P' and l_linenumber = 3 then 'Cancel PrimaryReservation'
            when o_orderstatus = 'F' and l_linenumber = 2 then 'End CommitmentTerm'
            else 'New ' || o_orderstatus end as reservation_deal_activity,
          l_orderkey % 3 = 0 as is_renewal_deal,
          {_id('Customer ', 'o_custkey')} as sales_account_name,
          {_id('Payer ', 'o_custkey % 500')} as billing_account_name,
          case when l_partkey % 41 = 0 then 'All Access' when l_partkey % 43 = 0 then null
            else p_name end as reservable_name,
          case when p_type = 'PROMO' then 'HD' when l_partkey % 23 = 0 then 'Acme All Access Plus'
            else p_type || ' desk' end as product,
          case p_size % 6 when 0 then 'Office' when 1 then 'DedicatedDesk'
            when 2 then 'SharedOfficeDesk' when 3 then null when 4 then 'HeadquartersByAcme'
            else 'Other' end as product_grouping,
          {_id('B', 'l_linenumber')} as commitment_bucket, {_SKU} as sku,
          case when p_size <= 20 then 'small' else 'large' end as sku_group,
          {_id('CUR', 's_nationkey % 5')} as currency,
          cast(p_size as bigint) as primary_reservation_capacity,
          case when l_partkey % 97 = 0 then null else cast(p_size as bigint) end
            as primary_reservation_capacity_today,
          case when rf = 'N' then 0 else cast(p_size as bigint) end as gross_desk_sales,
          case when l_orderkey % 3 = 0 then 0 else cast(p_size as bigint) end as new_desk_sales,
          case when l_orderkey % 3 = 0 then cast(p_size as bigint) else 0 end as renewal_desk_sales,
          cast(p_size * months as double) as desk_months,
          cast(price as decimal(18,2)) as reservation_price_usd,
          cast(price * (1 + n_nationkey % 5) as decimal(18,2)) as reservation_price_local,
          cast(cast(price * months * (100 - pct) as decimal(18,2)) * 0.01 as decimal(18,2))
            as core_committed_value_usd,
          cast(cast(price * (1 + n_nationkey % 5) * months * (100 - pct) as decimal(18,2)) * 0.01
            as decimal(18,2)) as core_committed_value_local,
          cast(({_BASE_PRICE} + addon) * months as decimal(18,2))
            as gross_committed_value_changed_before_discount_local,
          cast(addon * months as decimal(18,2)) as addon_committed_value_changed_local,
          case when o_custkey % 17 = 0 then true when o_custkey % 19 = 0 then null else false end
            as is_affiliate,
          {_day('o_orderdate')} as _run_at
        from (
          select l_orderkey, l_linenumber, max(l_partkey) as l_partkey, max(l_suppkey) as l_suppkey,
            max(l_returnflag) as rf,
            case when l_linenumber = 6 then null else cast(max(l_quantity) as bigint) % 30 end as months,
            cast(round(max(l_discount) * 100) as bigint) as pct,
            case when l_linenumber % 3 = 0 then 5 else 0 end as addon,
            case when l_orderkey % 37 = 0 then 0 else {_BASE_PRICE} * (1 + l_orderkey % 3) end as price
          from {{lineitem}} group by l_orderkey, l_linenumber) g
        join {{orders}} on l_orderkey = o_orderkey join {{part}} on l_partkey = p_partkey
        join {{supplier}} on l_suppkey = s_suppkey join {{nation}} on s_nationkey = n_nationkey
        join {{region}} on n_regionkey = r_regionkey""",
    "records": f"""
        select {_month('o_orderdate')} as sales_reporting_month,
          case when s_nationkey % 4 = 1 then 'Brazil' else 'Elsewhere' end as territory,
          {_id('D', 'l_orderkey')} as deal_uuid, {_RESERVATION} as primary_reservation_uuid,
          {_id('L', 's_nationkey')} as location_uuid, {_id('PR', 'l_partkey')} as price_id,
          1 + cast(l_partkey % 3 as double) / 8 as vat_adjust_factor,
          cast(l_quantity as int) % 4 as applied_months,
          cast(case when l_linenumber % 2 = 0 then -1 * {_BASE_PRICE} - 0.3
            else {_BASE_PRICE} + 1 end as decimal(18,2)) as price_local,
          cast({_BASE_PRICE} as decimal(18,2)) as price_usd_sales_comp_fx,
          cast(round(l_extendedprice) as decimal(18,2)) as committed_value_changed_local,
          cast(1 + l_partkey % 50 as bigint) as primary_reservation_capacity,
          case when l_returnflag = 'R' then 'DiscountReservation' else 'PrimaryReservation' end
            as sales_record_reservation_type,
          case when o_orderpriority = '1-URGENT' then 'Transfer In' else 'New' end as sales_record_type,
          case l_linenumber % 4 when 0 then 'Account Expansion' when 1 then 'Account Acquisition'
            when 2 then 'Account Upgrade' else 'Account Contraction' end as desk_account_impact,
          case when l_suppkey % 5 = 4 then null else l_suppkey % 2 = 0 end as is_renewal_deal,
          {_TERM} as term_id,
          case when l_orderkey % 5 = 0 then cast({_START} - interval '5' day as date)
            when l_orderkey % 5 = 1 then cast({_START} + interval '2' month as date)
            else {_START} end as term_start_date,
          case when l_orderkey % 5 = 0 then cast({_END} - interval '5' day as date)
            else {_END} end as term_end_date
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
          join {{supplier}} on l_suppkey = s_suppkey""",
    "desks": f"""
        select {_id('D', 'l_orderkey')} as deal_uuid, {_id('P', 'l_partkey')} as reservable_uuid,
          {_id('L', 's_nationkey')} as location_uuid, {_RESERVATION} as primary_reservation_uuid,
          case when r_name in ('AMERICA', 'ASIA') then 'US & Canada' else r_name end as region,
          case o_orderpriority when '1-URGENT' then 'Transfer' when '5-LOW' then 'Move Out Notice'
            else 'New' end as deal_type,
          {_day('o_orderdate')} as initial_sale_date, {_month('o_orderdate')} as sales_reporting_month,
          case when l_partkey % 29 = 0 then null else cast(l_linenumber as int) - 4 end
            as net_commitment_term_months_changed
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
          join {{supplier}} on l_suppkey = s_suppkey join {{nation}} on s_nationkey = n_nationkey
          join {{region}} on n_regionkey = r_regionkey""",
    "exits": f"""
        select {_id('L', 'n_nationkey')} as location_uuid,
          case when n_nationkey % 3 = 0 then null
            else 'F1,F12,F' || cast(n_nationkey as string) || ',F33,F40,F47' end as floor_uuids,
          case when n_nationkey % 5 = 1 then date '2022-11-10' else date '2022-09-15' end
            as member_communication_date,
          n_nationkey % 6 <> 2 as included_in_q_4_spiff
        from {{nation}} where n_nationkey % 4 in (0, 1, 2)""",
    "exclusions": f"""
        select {_id('D', 'o_orderkey')} as deal_uuid,
          'R' || cast(o_orderkey as string) || '-1' as reservation_uuid,
          case when o_orderkey % 50 = 0 then 'Renewal Contract Upload Error' else 'Sublease Deal' end
            as reason_for_exclusion
        from {{orders}} where o_orderkey % 50 in (0, 1)
        union all
        select {_id('D', 'o_orderkey')}, 'R' || cast(o_orderkey as string) || '-1', 'Other'
        from {{orders}} where o_orderkey % 150 in (1, 2)""",
    # Note snippets are fixed values; 120 orders in turn get one, appended to a whole document.
    "reservations": f"""
        select 'R' || cast(o_orderkey as string) || '-1' as uuid,
          case when doc_id % 17 = 0 then null else text || case doc_id % 24
            when 1 then ' Grow this with our US team' when 2 then ' gwu applied'
            when 3 then ' Q3 Dedicated space promo' when 4 then ' Growth at Campus'
            when 5 then ' AU for Q4 the Promo' when 6 then ' q4 Spacepromo' when 7 then ' Tourpromo'
            when 8 then ' a tiger deal' when 9 then ' FLEX in 2021' when 10 then ' flex2020'
            when 11 then ' New normal' when 12 then ' new-NORMAL' when 13 then ' Bad old apple'
            when 14 then ' ssqbadapple' when 15 then ' monthtomonth then upgrade'
            when 16 then ' RABBIT' when 17 then ' 100 Harris 4p' when 18 then ' 250 off OFFKR'
            when 19 then ' winter then promo' else '' end end as notes,
          o_orderdate + interval '24' year + interval '1' month * (case when doc_id % 5 = 0 then 2 else 0 end)
            as created_at,
          o_orderdate + interval '25' year as updated_at
        from {{documents}} join {{orders}} on o_orderkey = doc_id * 7""",
    "opportunities": f"""
        select {_id('O', 'o_orderkey')} as sf_opportunity_id,
          case when o_orderkey % 29 = 0 then null else {_id('U', 'o_custkey % 120')} end
            as opportunity_owner_id,
          o_orderpriority as referral_type
        from {{orders}}""",
    "team_members": f"""
        select {_id('O', 'l_orderkey')} as team_sf_object_id, {_id('U', 'l_suppkey')} as sf_user_id
        from {{lineitem}} where l_orderkey % 4 <> 3""",
    "users": f"""
        select {_id('U', 's_suppkey')} as sf_user_id,
          case when s_suppkey % 7 = 3 then null
            else 'rep' || cast(s_suppkey % 60 as string) || '@desk.example' end as email
        from {{supplier}}""",
    "discount_versions": f"""
        select {_id('P', 'l_partkey')} as reservable_uuid,
          case cast(l_quantity as int) % 5 when 0 then 1 when 1 then 6 when 2 then 12 when 3 then 24
            else 36 end as term,
          l_shipdate + interval '24' year as start_at,
          case when l_linenumber = 7 then null
            else l_shipdate + interval '24' year + interval '1' month * (cast(l_linenumber as int) * 3)
            end as end_at,
          case when l_suppkey % 31 = 0 then null else l_discount end as recommended_discount
        from {{lineitem}}""",
    "rates": f"""
        select {_month('o_orderdate')} as report_month,
          {_id('CUR', 'o_custkey % 5')} as source_currency,
          cast(max(o_custkey) % 97 as double) / 8 as budget_rate
        from {{orders}} where o_custkey % 5 <> 4
        group by {_month('o_orderdate')}, {_id('CUR', 'o_custkey % 5')}""",
}


_SPREAD_BY = {"lineitem": "l_orderkey", "documents": "doc_id"}
ONE_BLOCK = 128 << 20


def base_table(spark: SparkSession, sf_dir: str, name: str, spread_below: int = 0) -> DataFrame:
    """A base table; a big one in a single file of less than ``spread_below`` bytes is dealt out to all cores.

    Such a test file holds one row group, which one task would read and process
    alone. Larger inputs come in many row groups and are left as they are.
    """
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    if spread_below and name in _SPREAD_BY and os.path.isfile(path) and os.path.getsize(path) < spread_below:
        return df.repartition(spark.sparkContext.defaultParallelism, _SPREAD_BY[name])
    return df


BUCKET_ROWS = 400_000
_LAID_OUT = {"lineitem": "l_orderkey", "orders": "o_orderkey"}
_PLACES = {"region", "nation"}
_JOINED_ONCE = {"spaces", "deals"}


def laid_out(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """The columns of a base table that the views name, written once to scratch storage in buckets of ``key``.

    Views that join or group such tables by their keys read them where they lie, however often they are used.
    """
    used = [c for c in df.columns if any(re.search(rf"\b{c}\b", s) for s in ROLE_SQL.values())]
    name = f"deskmart_{uuid.uuid4().hex}"
    rows = df.select(*used).repartition(buckets, key)
    path = scratch(df.sparkSession)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    release(df.sparkSession, path)
    return df.sparkSession.table(name)


def joined_once(spark: SparkSession, view: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of a view, whose joined base rows are written once to scratch storage; what the view computes of them is computed where it is read.

    A view that is read several times would join its base tables as often, and move the rows for those too large to broadcast.
    """
    told, joins = re.match(r"(.*?)(\bfrom [{(].*)", view, re.S).groups()
    rows = spark.sql(f"select * {joins}", **tables)
    rows = materialize(rows.select(*[c for c in rows.columns if re.search(rf"\b{c}\b", told)]))
    return spark.sql(told + "from {rows}", rows=rows)


class LazyRoles(Roles):
    """Role views that are only analysed when an operator asks for them.

    With ``lay_out``, lines and orders are laid out by order for the views that join them, in buckets whose number grows with the lines, and
    small tables are broadcast by their number of rows. It pays where many views are read, as by the marts.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, spread_below: int = 0, lay_out: bool = False):
        super().__init__({})
        self._spark, self._sf_dir, self._spread_below, self._tables = spark, sf_dir, spread_below, {}
        self._lay_out, self._buckets, self._lock = lay_out, 0, threading.RLock()

    def _table(self, name: str, by_order: bool) -> DataFrame:
        """A base table, laid out by order if ``by_order``."""
        if (name, by_order) not in self._tables:
            if by_order:
                df = base_table(self._spark, self._sf_dir, name)
                self._buckets = self._buckets or max(self._spark.sparkContext.defaultParallelism, -(-base_table(self._spark, self._sf_dir, "lineitem").count() // BUCKET_ROWS))
                df = laid_out(df, _LAID_OUT[name], self._buckets)
            else:
                df = base_table(self._spark, self._sf_dir, name, 0 if self._lay_out and name in _LAID_OUT else self._spread_below)
                if self._lay_out and name not in (*_SPREAD_BY, *_LAID_OUT) and df.count() <= BROADCAST_ROWS:
                    df = F.broadcast(df)
            self._tables[name, by_order] = df
        return self._tables[name, by_order]

    def __getitem__(self, role: str) -> DataFrame:
        with self._lock:
            if role not in self._frames:
                used = [t for t in BASE_TABLES if "{" + t + "}" in ROLE_SQL[role]]
                joined = self._lay_out and set(_LAID_OUT) <= set(used)
                tables = {t: self._table(t, joined and t in _LAID_OUT) for t in used}
                once = self._lay_out and role in _JOINED_ONCE
                frame = joined_once(self._spark, ROLE_SQL[role], tables) if once else self._spark.sql(ROLE_SQL[role], **tables)
                if self._lay_out and set(used) <= _PLACES:
                    frame = F.broadcast(frame)
                self._frames.update(Roles({role: frame})._frames)
            return self._frames[role]

    def __getattr__(self, role: str) -> DataFrame:
        if role.startswith("_"):
            raise AttributeError(role)
        return self[role]


def oracle_views() -> dict[str, str]:
    """The same views as SQL over tables that are registered under their own names."""
    return {f"role_{r}": s.format(**{t: t for t in BASE_TABLES}) for r, s in ROLE_SQL.items()}
