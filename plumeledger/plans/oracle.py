"""The queries of ``queries`` in SQL, for a second engine on the same tables.

Each statement is built from named steps (WITH clauses); the steps restate the stand-ins
and operators independently of the DataFrame code.
"""

from __future__ import annotations

from ..schemas import TABLES
from .queries import (
    FIRST_QUANTITY,
    ISO,
    OWNERS,
    PARTIAL,
    SECTOR,
    SECTORS,
    SOME_YEARS,
    SOURCE,
    SUBSECTOR,
    YEAR,
)
from .standins import filler

PRICE = (
    "case l.l_returnflag when 'R' then -l.l_extendedprice "
    "when 'A' then l.l_extendedprice else 0.0 end"
)

def _exact(column: str) -> str:
    """The double nearest to the exact sum of doubles that are 0 or 0.001 and more in size: they
    are whole numbers of 2 ** -63, added as such and rounded once, by one addition."""
    total = f"sum(cast({column} * 9223372036854775808.0 as hugeint))"
    high, low = f"({total} // 1099511627776 // 4096)", f"({total} % (1099511627776 * 4096))"
    return f"(cast({high} as double) * 4503599627370496.0 + cast({low} as double)) / 9223372036854775808.0"


# Name -> (steps it needs, SQL).
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "sources": (
        (),
        f"""
        select p.p_type as subsector, l.l_suppkey as source_id, l.l_shipdate as start_time,
               s.s_name as source_name,
               case when s.s_acctbal < 0 then null else cast(s.s_nationkey as double) end as lat,
               s.s_acctbal as lon, {PRICE} as emissions_quantity, l.l_quantity as activity
        from lineitem l join part p on l.l_partkey = p.p_partkey
             join supplier s on l.l_suppkey = s.s_suppkey
        """,
    ),
    "country": (
        (),
        f"""
        select r.r_name as iso3_country, p.p_type as sector, p.p_brand as subsector,
               cast(year(l.l_shipdate) as integer) as year, 'co2' as gas,
               round(sum({PRICE}), 2) as emissions_quantity
        from lineitem l join part p on l.l_partkey = p.p_partkey
             join supplier s on l.l_suppkey = s.s_suppkey
             join nation n on s.s_nationkey = n.n_nationkey
             join region r on n.n_regionkey = r.r_regionkey
        group by r.r_name, p.p_type, p.p_brand, cast(year(l.l_shipdate) as integer)
        """,
    ),
    "ownership": (
        (),
        """
        select q.source_subsector, q.source_id, q.parent_entity_id, q.parent_name,
               q.parent_entity_type, n.n_name as parent_registration_country,
               case when q.bal < 0 then null else q.qty end as overall_share_percent,
               q.immediate_source_owner,
               q.immediate_source_owner || ' -> ' || q.parent_name as ownership_path
        from (select p.p_type as source_subsector, l.l_suppkey as source_id,
                     cast(c.c_custkey as varchar) as parent_entity_id, c.c_name as parent_name,
                     c.c_mktsegment as parent_entity_type, c.c_nationkey as nationkey,
                     s.s_name as immediate_source_owner,
                     max(c.c_acctbal) as bal, sum(l.l_quantity) as qty
              from lineitem l join part p on l.l_partkey = p.p_partkey
                   join orders o on l.l_orderkey = o.o_orderkey
                   join customer c on o.o_custkey = c.c_custkey
                   join supplier s on l.l_suppkey = s.s_suppkey
              group by p.p_type, l.l_suppkey, c.c_custkey, c.c_name, c.c_mktsegment,
                       c.c_nationkey, s.s_name) q
             join nation n on q.nationkey = n.n_nationkey
        """,
    ),
    "holdings": (
        (),
        """
        select q.source_id, q.parent_name,
               case when q.bal < 0 then null else q.qty end as overall_share_percent
        from (select l.l_suppkey as source_id, c.c_custkey as custkey, c.c_name as parent_name,
                     max(c.c_acctbal) as bal, sum(l.l_quantity) as qty
              from lineitem l join orders o on l.l_orderkey = o.o_orderkey
                   join customer c on o.o_custkey = c.c_custkey
              group by l.l_suppkey, c.c_custkey, c.c_name) q
        """,
    ),
    "controlling": (
        ("holdings",),
        """
        select source_id, parent_name as owner
        from (select *, row_number() over (partition by source_id
                     order by coalesce(overall_share_percent, 0) desc, parent_name) as rn
              from holdings where parent_name is not null) ranked
        where rn = 1
        """,
    ),
    "sector_year": (
        ("country",),
        """
        select iso3_country, year, sector, round(sum(emissions_quantity), 2) as emissions_quantity
        from country group by iso3_country, year, sector
        """,
    ),
    "source_year_exact": (
        ("sources",),
        f"""
        select subsector, cast(year(start_time) as integer) as year, source_id, source_name, lat, lon,
               {_exact('emissions_quantity')} as emissions_quantity
        from sources group by all
        """,
    ),
    "source_year": (
        ("sources",),
        """
        select subsector, cast(year(start_time) as integer) as year, source_id, source_name,
               lat, lon, round(sum(emissions_quantity), 2) as emissions_quantity
        from sources
        group by subsector, cast(year(start_time) as integer), source_id, source_name, lat, lon
        """,
    ),
    "owner_year": (
        ("source_year", "controlling"),
        """
        select c.owner, y.year, round(sum(y.emissions_quantity), 2) as emissions_quantity,
               cast(count(*) as integer) as source_count
        from source_year y join controlling c on y.source_id = c.source_id
        group by c.owner, y.year
        """,
    ),
    "top": (
        ("source_year",),
        """
        select subsector, year, cast(rn as integer) as rank, source_id, source_name, lat, lon,
               emissions_quantity
        from (select *, row_number() over (partition by subsector, year
                     order by emissions_quantity desc nulls last, source_id, source_name,
                              lat nulls first, lon nulls first) as rn
              from source_year) ranked
        where rn <= 20
        """,
    ),
    "newest": ((), "select cast(max(year(l_shipdate)) as integer) as year from lineitem"),
    "timeseries": (
        ("sector_year",),
        f"""
        select year, sector, emissions_quantity from sector_year where iso3_country = '{ISO}'
        """,
    ),
    "top_of_year": (
        ("owner_year",),
        f"""
        select owner, emissions_quantity, source_count from owner_year where year = {YEAR}
        order by emissions_quantity desc, owner limit 25
        """,
    ),
    "points": (
        ("source_year",),
        f"""
        select source_id, source_name, lat, lon, emissions_quantity from source_year
        where subsector = '{SUBSECTOR}' and year = {YEAR}
        """,
    ),
    # Facility-months as a keyed table: of equal keys the largest quantity stays.
    "monthly": (
        ("sources",),
        """
        select * exclude (rn)
        from (select *, row_number() over (partition by subsector, source_id, start_time
                     order by emissions_quantity desc, activity desc) as rn
              from sources) ranked
        where rn = 1
        """,
    ),
    "monthly_year": (
        ("monthly",),
        """
        select subsector, cast(year(start_time) as integer) as year, source_id, source_name,
               lat, lon, sum(emissions_quantity) as emissions_quantity
        from monthly
        group by subsector, cast(year(start_time) as integer), source_id, source_name, lat, lon
        """,
    ),
    "monthly_owner": (
        ("monthly_year", "ownership"),
        """
        select c.owner, y.year, round(sum(y.emissions_quantity), 2) as emissions_quantity,
               cast(count(*) as integer) as source_count
        from monthly_year y
             join (select source_id, parent_name as owner
                   from (select *, row_number() over (partition by source_id
                                order by coalesce(overall_share_percent, 0) desc, parent_name) as rn
                         from ownership) ranked
                   where rn = 1) c on y.source_id = c.source_id
        group by c.owner, y.year
        """,
    ),
    # Facility files: positive rows in entry a, negative in b, zero in c, which lacks gas.
    "files": (
        ("sources",),
        f"""
        select case when emissions_quantity > 0 then 'a' when emissions_quantity < 0 then 'b'
                    else 'c' end || '_emissions_sources_v1.csv' as entry, *
        from sources
        union all
        select '_first_emissions_sources_v1.csv', * replace ({FIRST_QUANTITY} as emissions_quantity)
        from sources
        """,
    ),
    # Facility years, and customers as facilities without owner.
    "with_customers": (
        ("source_year",),
        f"""
        select * from source_year
        union all
        select 'EXTRA', {YEAR}, c_custkey + 1000000, c_name, null, null, c_acctbal from customer
        """,
    ),
    # The last row of a key: negative rows over positive ones over those of the first file.
    "loaded": (
        ("sources",),
        f"""
        select subsector, source_id, start_time,
               '"' || source_name || '",' || chr(10) || 'unit' as source_name,
               emissions_quantity, activity
        from (select *, row_number() over (partition by subsector, source_id, start_time
                     order by place desc, emissions_quantity desc, activity desc) as rn
              from (select subsector, source_id, start_time, source_name, emissions_quantity, activity,
                           case when emissions_quantity > 0 then 1 else 2 end as place
                    from sources where emissions_quantity <> 0
                    union all
                    select subsector, source_id, start_time, source_name, {FIRST_QUANTITY}, activity, 0
                    from sources) f) ranked
        where rn = 1
        """,
    ),
}


def _with(needs: tuple[str, ...], body: str) -> str:
    """``body`` after the steps it needs, each once and in order of need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in STEPS[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body.strip()
    steps = ", ".join(f"{name} as ({STEPS[name][1]})" for name in ordered)
    return f"with {steps} {body.strip()}"


def _pivot(columns: tuple[str, ...], column: str, value: str) -> str:
    return ", ".join(
        f"max(case when {column} = '{c}' then {value} end) as \"{c}\"" for c in columns
    )


def _fixed(value: str, digits: int) -> str:
    """Decimal text of the exact binary value, halves away from zero.

    ``printf`` rounds exactly but halves to even; halves are the odd multiples of 1/2 (no
    decimals) or 1/4 (one decimal), for which the arithmetic below is exact.
    """
    size, unit = f"abs({value})", 2 + 2 * digits
    half = f"{size} * {unit} = floor({size} * {unit}) and floor({size} * {unit}) % 2 = 1"
    up = f"floor({size} * {10**digits} + 0.5) / {10**digits}"
    sign = f"case when {value} < 0 then '-' else '' end"
    return f"{sign} || printf('%.{digits}f', case when {half} then {up} else {size} end)"


_TONNES = f"""
    case when abs(q) >= 1e6 then {_fixed('(q / 1e6)', 1)} || ' Mt'
         when abs(q) >= 1e3 then {_fixed('(q / 1e3)', 1)} || ' kt'
         else {_fixed('q', 0)} || ' t' end
"""

_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160) || chr(8239)"

_DRAWABLE = "lat is not null and lon is not null and emissions_quantity > 0"

_LINE_KEY_ORDER = (
    "l_shipdate desc, l_extendedprice desc, l_partkey, l_suppkey, l_quantity, l_discount, "
    "l_tax, l_returnflag"
)

_SELECTED = f"subsector <> '{SUBSECTOR}' and year in {SOME_YEARS}"


def _filled(name: str, **given: str) -> str:
    """All columns of a table: those given, the others as the stand-ins fill them."""
    return ", ".join(
        f"{given.get(c) or filler(name, c)} as {c}" for c in TABLES[name].columns
    )


ORACLE: dict[str, str] = {
    "sector_year_totals": _with(("sector_year",), "select * from sector_year"),
    "national_total_by_year": _with(
        ("sector_year",),
        "select year, round(sum(emissions_quantity), 2) as national_total from sector_year group by year",
    ),
    "source_year_rollup": _with(("source_year",), "select * from source_year"),
    "source_year_by_key": _with(
        ("sources",),
        """
        select subsector, year, source_id, source_name, lat, lon, emissions_quantity
        from (select *, row_number() over (partition by subsector, year, source_id
                     order by emissions_quantity desc, source_name, lat, lon) as rn
              from (select subsector, cast(year(start_time) as integer) as year,
                           coalesce(cast(lat as bigint), -1) as source_id, source_name, lat, lon,
                           round(sum(emissions_quantity), 2) as emissions_quantity
                    from sources group by 1, 2, 3, 4, 5, 6) y) ranked
        where rn = 1
        """,
    ),
    "owner_year_attribution": _with(("owner_year",), "select * from owner_year"),
    "latest_year": _with(("source_year",), "select max(year) as latest_year from source_year"),
    "latest_year_rows": _with(
        ("sector_year",),
        "select * from sector_year where year = (select max(year) from sector_year)",
    ),
    "top_sectors_latest": _with(
        ("sector_year", "newest"),
        """
        select s.* from sector_year s join newest using (year)
        order by emissions_quantity desc nulls last, iso3_country, sector limit 20
        """,
    ),
    "top_owners_latest": _with(
        ("owner_year",),
        """
        select o.* from owner_year o where year = (select max(year) from owner_year)
        order by emissions_quantity desc nulls last, owner limit 10
        """,
    ),
    "top_facilities_latest": _with(
        ("top", "newest"),
        f"""
        select t.* from top t join newest using (year) where subsector = '{SUBSECTOR}'
        order by rank limit 10
        """,
    ),
    "top_sources": _with(("top",), "select * from top"),
    "table_counts": _with(
        ("sector_year", "top", "owner_year"),
        """
        select 'sector_year' as table_name, count(*) as row_count from sector_year
        union all select 'source_year', count(*) from source_year
        union all select 'top_sources', count(*) from top
        union all select 'owner_year', count(*) from owner_year
        """,
    ),
    "controlling_parent": _with(("controlling",), "select * from controlling"),
    "owner_attribution_join": _with(
        ("source_year", "controlling"),
        "select y.*, c.owner from source_year y join controlling c on y.source_id = c.source_id",
    ),
    "unowned_sources": _with(
        ("with_customers", "controlling"),
        """
        select * from with_customers y
        where not exists (select 1 from controlling c where c.source_id = y.source_id)
        """,
    ),
    "with_confidence": _with(
        ("monthly",),
        """
        select m.subsector, m.source_id, m.start_time, m.source_name, m.emissions_quantity, m.activity,
               case when r.most > 40 then 'high' when r.most > 25 then 'medium' end as activity_confidence
        from monthly m join (select subsector, source_id, start_time, max(activity) as most
                             from sources group by subsector, source_id, start_time) r
             on m.subsector = r.subsector and m.source_id = r.source_id and m.start_time = r.start_time
        """,
    ),
    "sources_with_owners": _with(
        ("with_customers", "ownership"),
        """
        select t.*, o.parent_entity_id, o.parent_name, o.parent_entity_type,
               o.parent_registration_country, o.overall_share_percent, o.immediate_source_owner,
               o.ownership_path
        from (select subsector, year, cast(rn as integer) as rank, source_id, source_name, lat, lon,
                     emissions_quantity
              from (select *, row_number() over (partition by subsector, year
                           order by emissions_quantity desc nulls last, source_id, source_name,
                                    lat nulls first, lon nulls first) as rn
                    from with_customers) ranked
              where rn <= 20) t
        left join ownership o on t.subsector = o.source_subsector and t.source_id = o.source_id
        """,
    ),
    "list_sectors": _with(
        ("country",), f"select distinct sector from country where iso3_country = '{ISO}'"
    ),
    "list_sectors_set": _with(
        ("country",), f"select distinct iso3_country, sector from country where iso3_country <> '{ISO}'"
    ),
    "list_subsectors": _with(
        ("country",),
        f"""
        select distinct subsector from country
        where iso3_country = '{ISO}' and sector = '{SECTOR}'
        """,
    ),
    "list_years": _with(
        ("sector_year",), f"select distinct year from sector_year where iso3_country = '{ISO}'"
    ),
    "top_owners_of_year": _with(("top_of_year",), "select * from top_of_year"),
    "top_owners_by_year": _with(
        ("owner_year",),
        """
        select year, owner, emissions_quantity, source_count, cast(rn as integer) as rank
        from (select *, row_number() over (partition by year
                     order by emissions_quantity desc, owner) as rn from owner_year) ranked
        where rn <= 25
        """,
    ),
    "owner_trend": _with(
        ("owner_year",),
        f"""
        select year, emissions_quantity, source_count from owner_year where owner = '{OWNERS[0]}'
        """,
    ),
    "owner_trend_set": _with(
        ("owner_year",),
        """
        select owner, year, emissions_quantity, source_count from owner_year
        where owner in (select c_name from customer where c_mktsegment = 'BUILDING')
        """,
    ),
    "sector_timeseries": _with(("timeseries",), "select * from timeseries"),
    "sector_timeseries_set": _with(
        ("sector_year",), f"select * from sector_year where iso3_country <> '{ISO}'"
    ),
    "sector_subsectors": _with(
        ("country",),
        f"""
        select subsector, year, emissions_quantity from country
        where iso3_country = '{ISO}' and sector = '{SECTOR}'
        """,
    ),
    "sector_subsectors_set": _with(
        ("country",),
        f"""
        select iso3_country, sector, subsector, year, emissions_quantity from country
        where iso3_country <> '{ISO}' and sector <> '{SECTORS[0]}'
        """,
    ),
    "top_of_subsector_year": _with(
        ("top",),
        f"""
        select rank, source_id, source_name, lat, lon, emissions_quantity from top
        where subsector = '{SUBSECTOR}' and year = {YEAR}
        """,
    ),
    "top_of_set": _with(("top",), f"select * from top where {_SELECTED}"),
    "points_of_subsector_year": _with(("points",), "select * from points"),
    "points_of_set": _with(("source_year",), f"select * from source_year where {_SELECTED}"),
    "ownership_of_source": _with(
        ("ownership",),
        f"""
        select parent_name, parent_entity_type, parent_registration_country,
               overall_share_percent, immediate_source_owner, ownership_path
        from ownership where source_subsector = '{SUBSECTOR}' and source_id = {SOURCE}
        """,
    ),
    "ownership_of_set": _with(
        ("top", "ownership"),
        f"""
        select o.source_subsector, o.source_id, o.parent_name, o.parent_entity_type,
               o.parent_registration_country, o.overall_share_percent,
               o.immediate_source_owner, o.ownership_path
        from ownership o join (select subsector, source_id from top where year = {YEAR}) t
             on o.source_subsector = t.subsector and o.source_id = t.source_id
        """,
    ),
    "facility_months": _with(
        ("monthly",),
        f"""
        select start_time, emissions_quantity, activity, cast(null as double) as capacity
        from monthly where subsector = '{SUBSECTOR}' and source_id = {SOURCE}
        order by start_time limit 12
        """,
    ),
    "facility_months_set": _with(
        ("monthly",),
        f"""
        select subsector, source_id, start_time, emissions_quantity, activity,
               cast(null as double) as capacity
        from (select *, row_number() over (partition by subsector, source_id
                     order by start_time) as place from monthly) placed
        where place <= 12 and subsector <> '{SECTORS[0]}'
        """,
    ),
    "sector_pivot": _with(
        ("timeseries",),
        f"""
        select year, {_pivot(SECTORS, 'sector', 'greatest(emissions_quantity, 0.0)')}
        from timeseries group by year
        """,
    ),
    "sector_share": _with(
        ("timeseries",),
        """
        select t.year, t.sector, t.emissions_quantity, round(a.total, 2) as total,
               round(t.emissions_quantity / a.total, 6) as share
        from timeseries t join (select year, sum(emissions_quantity) as total from timeseries
                                where emissions_quantity > 0 group by year) a using (year)
        where t.emissions_quantity > 0
        """,
    ),
    "sector_share_of_year": _with(
        ("timeseries",),
        f"""
        select t.year, t.sector, t.emissions_quantity, round(a.total, 2) as total,
               round(t.emissions_quantity / a.total, 6) as share
        from timeseries t cross join (select sum(emissions_quantity) as total from timeseries
                                      where emissions_quantity > 0 and year = {YEAR}) a
        where t.emissions_quantity > 0 and t.year = {YEAR}
        """,
    ),
    "map_points": _with(
        ("points",),
        f"""
        select p.*, round(4 + 26 * sqrt(emissions_quantity / (select greatest(
               max(emissions_quantity), 1.0) from points where {_DRAWABLE})), 6) as radius
        from points p where {_DRAWABLE}
        """,
    ),
    "map_points_set": _with(
        ("source_year",),
        f"""
        select y.*, round(4 + 26 * sqrt(emissions_quantity / greatest(largest, 1.0)), 6) as radius
        from source_year y join (select subsector, year, max(emissions_quantity) as largest
                                 from source_year where {_DRAWABLE} group by subsector, year) m
             using (subsector, year)
        where {_DRAWABLE}
        """,
    ),
    "selection_summary": _with(
        ("points",),
        """
        select count(*) as facilities, coalesce(round(sum(emissions_quantity), 2), 0.0) as total
        from points
        """,
    ),
    "selection_summary_set": _with(
        ("source_year",),
        """
        select subsector, year, count(*) as facilities, round(sum(emissions_quantity), 2) as total
        from source_year group by subsector, year
        """,
    ),
    "owner_trend_compare": _with(
        ("owner_year",),
        f"""
        select year, {_pivot(OWNERS, 'owner', 'emissions_quantity')} from owner_year
        where owner in ({', '.join(f"'{o}'" for o in OWNERS)}) and year <> {PARTIAL} group by year
        """,
    ),
    "owner_change": _with(
        ("owner_year",),
        f"""
        select owner, points, first, last, round(change, 6) as change, change < 0 as reduced
        from (select owner, points, first, last,
                     case when points >= 2 and first > 0 then (last - first) / first end as change
              from (select owner, count(*) as points,
                           arg_min(emissions_quantity, year) as first,
                           arg_max(emissions_quantity, year) as last
                    from owner_year where year <> {PARTIAL} group by owner) e) c
        """,
    ),
    "default_owners": _with(
        ("top_of_year",),
        "select owner from top_of_year order by emissions_quantity desc, owner limit 3",
    ),
    "fmt_tonnes": _with(
        ("source_year",),
        f"""
        select subsector, year, source_id, q as emissions_quantity, {_TONNES} as shown
        from (select subsector, year, source_id, emissions_quantity as q from source_year
              union all
              select l_linestatus, cast(null as integer), l_orderkey, l_quantity from lineitem) r
        """,
    ),
    # Part names and types are plain words of letters, so the first letters are known.
    "pretty_label": """
        select p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
               lambda w: upper(w[1]) || w[2:]), ' ') || ' O''Clock_x ' || p_type as label
        from part
    """,
    "category_index": """
        select n_name, cast(case when used then (place - 1) % 10 else 0 end as integer) as category_index
        from (select n.n_name, u.n_name is not null as used, u.place
              from nation n left join (
                   select n_name, row_number() over (order by n_name) as place
                   from (select distinct n_name from nation
                         where n_nationkey in (select s_nationkey from supplier)) d) u
              on n.n_name = u.n_name) x
    """,
    "display_name": """
        select s_suppkey,
               case when s_acctbal >= 0 then s_name else 'Unknown' end as shown,
               case when s_acctbal >= 0 then s_name else 'Source ' || s_suppkey end as heading
        from supplier
    """,
    "year_coverage": _with(
        ("source_year",),
        """
        select cast(d.year as integer) as year, coalesce(c.rows, 0) as rows
        from (select unnest(range(1994, 2006)) as year) d
             left join (select year, count(*) as rows from source_year group by year) c
             on d.year = c.year
        """,
    ),
    "convert_timestamps": """
        select event_id, ts as fraction, date_trunc('second', ts) as seconds,
               date_trunc('second', ts) as wide_gap,
               cast(cast(ts as date) as timestamp) as day,
               cast(cast(ts as date) as timestamp) as short_day,
               cast(null as timestamp) as year_only, cast(null as timestamp) as zoned,
               cast(null as timestamp) as offset, cast(null as timestamp) as bad_month,
               cast(null as timestamp) as long_fraction
        from events
    """,
    "convert_doubles": """
        select l_orderkey, l_linenumber, l_linestatus, l_extendedprice as plain,
               l_extendedprice as padded, l_extendedprice as signed,
               cast(l_linenumber * 100 as double) as exponent,
               cast(1000 + l_linenumber as double) as separated,
               cast(null as double) as suffixed, cast(null as double) as hexadecimal,
               cast(null as double) as word, cast(null as double) as blank,
               l_linestatus = 'O' as is_nan, l_linestatus <> 'O' as is_infinite
        from lineitem
    """,
    "convert_longs": """
        select l_partkey, l_orderkey as id, l_orderkey as id_as_float,
               cast(trunc(l_extendedprice) as bigint) as cut,
               -cast(trunc(l_extendedprice) as bigint) as cut_negative,
               cast(l_linenumber * 1000 as bigint) as exponent, cast(null as bigint) as nan,
               cast(null as bigint) as infinite, cast(null as bigint) as word
        from lineitem
    """,
    "clean_text": f"""
        select doc_id, nullif(trim(text, {_SPACES}), '') as text, cast(null as varchar) as blank
        from documents
    """,
    "year_prefix": """
        select o_orderkey, cast(year(o_orderdate) as integer) as day,
               cast(year(o_orderdate) as integer) as year_only,
               cast(null as integer) as padded, cast(null as integer) as short,
               cast(null as integer) as word
        from orders
    """,
    "pairs_to_map": """
        select o_orderkey, 'priority=' || o_orderpriority || ';status='
               || case when o_totalprice > 250000 then 'large' else o_orderstatus end as other
        from orders
    """,
    "latest_rows": f"""
        select * exclude (rn)
        from (select *, row_number() over (partition by l_orderkey, l_linenumber
                     order by {_LINE_KEY_ORDER}) as rn from lineitem) ranked
        where rn = 1
    """,
    "upsert_latest": f"""
        select * exclude (rn)
        from (select *, row_number() over (partition by l_orderkey, l_linenumber
                     order by l_linestatus desc, {_LINE_KEY_ORDER}) as rn from lineitem) ranked
        where rn = 1
    """,
    "stored_upsert": _with(
        ("sources",),
        """
        select subsector, source_id, start_time, source_name, emissions_quantity, activity
        from (select *, row_number() over (partition by subsector, source_id, start_time
                     order by emissions_quantity > 0, emissions_quantity desc, activity desc) as rn
              from sources) ranked
        where rn = 1
        """,
    ),
    "analysis_counts": _with(
        ("sector_year", "monthly_year", "monthly_owner"),
        """
        select 'analysis_sector_year' as table_name, count(*) as row_count from sector_year
        union all select 'analysis_source_year', count(*) from monthly_year
        union all select 'analysis_top_sources', cast(sum(least(n, 20)) as bigint) from
                  (select count(*) as n from monthly_year group by subsector, year) g
        union all select 'analysis_owner_year', count(*) from monthly_owner
        union all select 'analysis_owner_trend', count(*) from monthly_owner
        """,
    ),
    "analysis_written": _with(
        ("sector_year", "monthly_year", "monthly_owner"),
        """
        select 'analysis_sector_year' as table_name, count(*) as row_count from sector_year
        union all select 'analysis_source_year', count(*) from monthly_year
        union all select 'analysis_top_sources', cast(sum(least(n, 20)) as bigint) from
                  (select count(*) as n from monthly_year group by subsector, year) g
        union all select 'analysis_owner_year', count(*) from monthly_owner
        union all select 'analysis_owner_trend', count(*) from monthly_owner
        """,
    ),
    "analysis_owner_trend": _with(("monthly_owner",), "select * from monthly_owner"),
    "ingest_sources": _with(
        ("files",),
        "select entry, "
        + _filled(
            "emissions_sources",
            subsector="subsector",
            source_id="source_id",
            start_time="start_time",
            source_name="""'"' || source_name || '",' || chr(10) || 'unit'""",
            lat="lat",
            lon="lon",
            gas=f"case when entry[1] <> 'c' then {filler('emissions_sources', 'gas')} end",
            emissions_quantity="emissions_quantity",
            activity="activity",
            capacity="cast(null as double)",
            other="'load=' || cast(activity as varchar)",
        )
        + ", case when entry[1] = 'c' then 'missing column(s): gas' end as reason from files",
    ),
    "reject_counts": _with(
        ("files",),
        """
        select 'good' as table_name, count(*) as row_count from files where emissions_quantity <> 0
        union all select 'rejects', count(*) from files where emissions_quantity = 0
        """,
    ),
    "ingest_country": _with(
        ("country",),
        "select "
        + _filled(
            "country_emissions",
            iso3_country="iso3_country",
            sector="sector",
            subsector="subsector",
            year="year",
            gas="gas",
            start_time="make_timestamp(year, 1, 1, 0, 0, 0.0)",
            emissions_quantity="emissions_quantity",
        )
        + " from country",
    ),
    "ingest_confidence": "select "
    + _filled(
        "emissions_sources_confidence",
        subsector="d.lang",
        source_id="l.doc_id",
        start_time="timestamp '2015-01-01 00:00:00'",
        activity="case when l.quality = 1 then 'high' end",
        capacity="cast(l.toxic as varchar)",
    )
    + " from labels l join documents d on l.doc_id = d.doc_id",
    "ingest_ownership": _with(
        ("ownership",),
        "select "
        + _filled(
            "emissions_sources_ownership",
            source_subsector="source_subsector",
            source_id="source_id",
            parent_entity_id="case when overall_share_percent is null then '?' else parent_entity_id end",
            parent_name="parent_name",
            parent_entity_type="parent_entity_type",
            parent_registration_country="parent_registration_country",
            overall_share_percent="overall_share_percent",
            immediate_source_owner="immediate_source_owner",
            ownership_path="ownership_path",
        )
        + " from ownership",
    ),
    # Of the kinds only facility files exist; rows without gas are rejected.
    "csv_load_report": _with(
        ("files",),
        """
        select * from (
          select 'emissions_sources' as kind, entry, count(*) filter (emissions_quantity <> 0) as rows,
                 count(*) filter (emissions_quantity = 0) as rejected, 1 as files
          from files group by entry
          union all select 'emissions_sources', null, count(*) filter (emissions_quantity <> 0),
                 count(*) filter (emissions_quantity = 0), count(distinct entry) from files
          union all select null, null, count(*) filter (emissions_quantity <> 0),
                 count(*) filter (emissions_quantity = 0), count(distinct entry) from files) r
        """,
    ),
    "csv_kinds": _with(
        ("files",),
        """
        select 'emissions_sources' as table_name, count(*) as row_count from files where entry[1] = 'b'
        union all select 'ownership', 0
        """,
    ),
    "csv_rejects_rerun": _with(
        ("files",),
        """
        select entry, 'missing column(s): gas' as reason, count(*) as rows
        from files where emissions_quantity = 0 group by entry
        """,
    ),
    "category_index_many": """
        select k.key, cast(coalesce((u.place - 1) % 10, 0) as integer) as category_index
        from (select cast(o_orderkey as varchar) as key from orders) k
             left join (select key, row_number() over (order by key) as place
                        from (select distinct cast(o_orderkey as varchar) as key from orders
                              where o_orderstatus <> 'F') d) u on k.key = u.key
    """,
    "reload_many_directories": _with(
        ("monthly",),
        """
        select subsector || '/' || coalesce(cast(cast(lat as integer) as varchar), 'none') as subsector,
               source_id, start_time,
               case when emissions_quantity > 0 then 2 else 1 end * emissions_quantity as emissions_quantity,
               activity
        from monthly
        """,
    ),
    "refresh_shrinks": _with(("top",), "select * from top where rank <= 5"),
    "stored_list_sectors": _with(
        ("country",), f"select distinct sector from country where iso3_country = '{ISO}'"
    ),
    "stored_top_owners": _with(
        ("monthly_owner",),
        f"""
        select owner, emissions_quantity, source_count from monthly_owner where year = {YEAR}
        order by emissions_quantity desc, owner limit 25
        """,
    ),
    "stored_owner_trend": _with(
        ("monthly_owner",),
        f"""
        select year, emissions_quantity, source_count from monthly_owner
        where owner = (select owner from monthly_owner where year = {YEAR}
                       order by emissions_quantity desc, owner limit 1)
        """,
    ),
    "stored_sector_timeseries": _with(("timeseries",), "select * from timeseries"),
    "stored_sector_subsectors": _with(
        ("country",),
        f"""
        select subsector, year, emissions_quantity from country
        where iso3_country = '{ISO}' and sector = '{SECTOR}'
        """,
    ),
    "stored_top_of": _with(
        ("monthly_year",),
        f"""
        select cast(rn as integer) as rank, source_id, source_name, lat, lon,
               round(emissions_quantity, 2) as emissions_quantity
        from (select *, row_number() over (order by round(emissions_quantity, 6) desc, source_id) as rn
              from monthly_year where subsector = '{SUBSECTOR}' and year = {YEAR}) ranked
        where rn <= 20
        """,
    ),
    "stored_points_of": _with(
        ("monthly_year",),
        f"""
        select source_id, source_name, lat, lon, round(emissions_quantity, 2) as emissions_quantity
        from monthly_year where subsector = '{SUBSECTOR}' and year = {YEAR}
        """,
    ),
    "stored_ownership_of": _with(
        ("ownership",),
        f"""
        select parent_name, parent_entity_type, parent_registration_country,
               overall_share_percent, immediate_source_owner, ownership_path
        from ownership where source_subsector = '{SUBSECTOR}' and source_id = {SOURCE}
        """,
    ),
    "stored_facility_months": _with(
        ("monthly",),
        f"""
        select start_time, emissions_quantity, activity, cast(null as double) as capacity
        from monthly where subsector = '{SUBSECTOR}' and source_id = {SOURCE}
        order by start_time limit 12
        """,
    ),
    "sector_year_exact": _with(
        ("sources",),
        f"""
        select '{ISO}' as iso3_country, cast(year(start_time) as integer) as year, subsector as sector,
               {_exact('emissions_quantity')} as emissions_quantity
        from sources group by all
        """,
    ),
    "national_total_exact": _with(
        ("sources",),
        f"""
        select cast(year(start_time) as integer) as year, {_exact('emissions_quantity')} as national_total
        from sources group by all
        """,
    ),
    "source_year_exact": _with(("source_year_exact",), "select * from source_year_exact"),
    "owner_year_exact": _with(
        ("source_year_exact", "controlling"),
        f"""
        select owner, year, {_exact('emissions_quantity')} as emissions_quantity,
               cast(count(*) as integer) as source_count
        from source_year_exact join controlling using (source_id) group by owner, year
        """,
    ),
    "incremental_rollups": _with(
        ("monthly", "ownership"),
        f"""
        , batched as (
          select subsector, cast(year(start_time) as integer) as year, source_id, lat, lon,
                 case when emissions_quantity > 0 and activity > 40 then source_name || ' (new)'
                      else source_name end as source_name,
                 case when emissions_quantity > 0 and activity > 25 then 2 * emissions_quantity
                      when emissions_quantity > 0 and activity between 10 and 25 then -emissions_quantity
                      else emissions_quantity end as q
          from monthly),
        years as (
          select subsector, year, source_id, source_name, lat, lon, {_exact('q')} as q from batched group by all),
        ranked as (
          select *, row_number() over (partition by subsector, year order by q desc nulls last, source_id,
                      source_name, lat nulls first, lon nulls first) as r,
                 row_number() over (partition by subsector, year, source_id order by q desc nulls last,
                      source_name, lat nulls first, lon nulls first) as v
          from years)
        select 'source_year' as rollup, subsector as label, year, source_id as number, source_name as name,
               q as emissions_quantity from ranked where v = 1
        union all
        select 'top_sources', subsector, year, r, source_name, q from ranked where r <= 20
        union all
        select 'owner_year', owner, year, count(*), '', {_exact('q')}
        from years join (select source_id, parent_name as owner
                         from (select *, row_number() over (partition by source_id
                                      order by coalesce(overall_share_percent, 0) desc, parent_name) as rn
                               from ownership) o where rn = 1) c using (source_id)
        group by owner, year
        """,
    ),
    "sql_functions": _with(
        ("monthly_owner", "timeseries", "country", "monthly", "monthly_year", "ownership"),
        f"""
        select 'top_owners' as lookup, owner as label, source_count as number, emissions_quantity as quantity
        from monthly_owner where year = {YEAR}
        union all select 'timeseries', sector, year, emissions_quantity from timeseries
        union all select 'subsectors', subsector, year, emissions_quantity from country
                  where sector = '{SECTOR}' and iso3_country = '{ISO}'
        union all select distinct 'sectors', sector, 0, cast(0 as double) from country where iso3_country = '{ISO}'
        union all select 'months', strftime(start_time, '%Y-%m-%d'), cast(activity as integer), round(emissions_quantity, 2)
                  from monthly where subsector = '{SUBSECTOR}' and source_id = {SOURCE}
        union all select 'owners', parent_name, {SOURCE}, coalesce(overall_share_percent, 0.0)
                  from ownership where source_subsector = '{SUBSECTOR}' and source_id = {SOURCE}
        union all select 'trend', owner, year, emissions_quantity from monthly_owner
                  where owner in (select owner from monthly_owner where year = {YEAR})
        union all select 'points', subsector, cast(source_id as integer), round(emissions_quantity, 2) from monthly_year
        union all select 'top', subsector, cast(unnest(generate_series(1, least(n, 20))) as integer), cast(0 as double)
                  from (select subsector, year, count(*) as n from monthly_year group by all)
        """,
    ),
    "bucketed_owners": _with(
        ("sources", "controlling"),
        """
        select owner, source_id, count(*) as rows, max(emissions_quantity) as largest
        from sources join controlling using (source_id) group by owner, source_id
        """,
    ),
    "bloom_lookup": _with(
        ("sources",),
        f"""
        select subsector, source_id, start_time, emissions_quantity, activity from sources where source_id = {SOURCE}
        """,
    ),
    "csv_to_table": _with(("loaded",), "select * from loaded"),
    "stream_to_table": _with(("loaded",), "select * from loaded"),
    "stream_continuous": _with(
        ("monthly",),
        "select subsector, source_id, start_time, source_name, emissions_quantity, activity from monthly",
    ),
    "csv_line_breaks": r"""
        select cast(doc_id as varchar) as doc_id, lang, md5(t) as text_md5
        from (select doc_id, lang, regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') as t from documents)
        where t <> ''
        """,
}
