"""The same results as plain SQL, for the comparison with another engine.

The SQL takes other routes than the Spark operators where there are any: gaps are filled by a
calendar join, and deduplication is a plain window.
"""

from __future__ import annotations

from monthspan.plans.given import MIN_YEAR, MONTH_YEAR, PRODUCT, RAW_TEXT, ROWS_PER_FILE, VOLUME_OR_NULL

CARRIED_SMALL = ["FIELD", "TWN_DIR", "MONTH-YEAR", "PRODUCT"]
INTS = ["DOR_CODE", "TOWNSHIP", "RANGE", "SECTION", "WELLS"]
FLOATS = ["LATITUDE", "LONGITUDE", "PRODUCTION"]
MONTHLY = [name for name in RAW_TEXT if name != "URL"]
CARRIED_MONTHLY = [c for c in MONTHLY if c not in ("LEASE_KID", "PRODUCTION")]


def q(name: str) -> str:
    return f'"{name}"'


def names(columns: list[str]) -> str:
    return ", ".join(map(q, columns))


# Building blocks: each is the text of one or more common table expressions

RAW_SMALL = f"""raw as (
  select o_custkey as LEASE_KID,
         nullif({RAW_TEXT["FIELD"]}, '') as FIELD,
         {RAW_TEXT["TWN_DIR"]} as TWN_DIR,
         {MONTH_YEAR} as "MONTH-YEAR",
         {PRODUCT} as PRODUCT,
         cast({VOLUME_OR_NULL} as double) as PRODUCTION,
         o_orderkey
  from orders)"""

RAW_ALL = "raw_text as (select {}, o_orderkey from orders)".format(
    ", ".join(f"{sql} as {q(name)}" for name, sql in RAW_TEXT.items())
)


def _typed(name: str) -> str:
    if name == "LEASE_KID":
        return "cast(LEASE_KID as bigint) as LEASE_KID"
    if name in INTS:
        return f"cast(try_cast({q(name)} as double) as bigint) as {q(name)}"
    if name in FLOATS:
        number = f"try_cast({q(name)} as double)"
        return f"case when not isnan({number}) then {number} end as {q(name)}"
    return f"nullif({q(name)}, '') as {q(name)}"


TYPED_ALL = f"{RAW_ALL}, raw as (select {', '.join(map(_typed, MONTHLY))}, o_orderkey from raw_text)"

YEAR = "string_split(\"MONTH-YEAR\", '-')[-1]"
RECENT = f"""recent as (
  select * from raw
  where regexp_matches({YEAR}, '^[0-9]+$') and try_cast({YEAR} as bigint) >= {MIN_YEAR})"""


def dated(source: str, name: str = "dated") -> str:
    return f"""{name} as (
  select * exclude (m, y), make_date(y, m, 1) as production_date from (
    select *, try_cast(regexp_extract("MONTH-YEAR", '^([0-9]+)-([0-9]+)', 1) as bigint) as m,
              try_cast(regexp_extract("MONTH-YEAR", '^([0-9]+)-([0-9]+)', 2) as bigint) as y
    from {source})
  where m between 1 and 12 and y between 1 and 9999)"""


def categorized(source: str, name: str, more: bool) -> str:
    changed = [
        "case when PRODUCT in ('O', 'G') then PRODUCT end as PRODUCT",
        "case when TWN_DIR in ('S', 'N') then TWN_DIR end as TWN_DIR",
    ]
    if more:
        changed.append("case when RANGE_DIR in ('E', 'W') then RANGE_DIR end as RANGE_DIR")
    return f"{name} as (select * replace ({', '.join(changed)}) from {source})"


def bounded(source: str, name: str) -> str:
    return f"""{name} as (
  select * replace (case when PRODUCTION < 0 or (PRODUCT = 'O' and PRODUCTION > 50000) then null
                         else PRODUCTION end as PRODUCTION)
  from {source})"""


def first_of(source: str, keys: str, name: str, position: str = "o_orderkey") -> str:
    return f"""{name} as (
  select * from {source}
  qualify row_number() over (partition by {keys} order by {position}) = 1)"""


def calendar_join(
    source: str,
    name: str,
    carried: list[str],
    by_product: bool = False,
    zero_fill: bool = True,
    mark: bool = False,
) -> str:
    series = "LEASE_KID, PRODUCT" if by_product else "LEASE_KID"
    keys = [c for c in series.split(", ")]
    match = " and ".join(f"c.{k} is not distinct from u.{k}" for k in keys)
    volume = "coalesce(u.PRODUCTION, 0.0)" if zero_fill else "u.PRODUCTION"
    columns = [f"c.{k}" for k in keys]
    columns += [
        f"last_value(u.{q(c)} ignore nulls) over w as {q(c)}" for c in carried if c not in keys
    ]
    columns.append(
        f"case when u.production_date is null then 0.0 else {volume} end as PRODUCTION"
    )
    columns.append("c.production_date")
    if mark:
        columns.append("u.production_date is null as is_filled")
    partition = ", ".join(f"c.{k}" for k in keys)
    return f"""span as (
  select {series}, min(production_date) as a, max(production_date) as b from {source} group by {series}),
cal as (
  select {series}, cast(unnest(generate_series(a, b, interval 1 month)) as date) as production_date
  from span),
{name} as (
  select {", ".join(columns)}
  from cal c left join {source} u on {match} and c.production_date = u.production_date
  window w as (partition by {partition} order by c.production_date
               rows between unbounded preceding and current row))"""


# One chain for the small typed columns, one for all columns of a monthly file
CLEANED = ", ".join(
    [RAW_SMALL, dated("raw"), categorized("dated", "cats", False), bounded("cats", "cleaned")]
)
UNIQUE = f"{CLEANED}, {first_of('cleaned', 'LEASE_KID, production_date', 'uniq')}"
UNIQUE_P = f"{CLEANED}, {first_of('cleaned', 'LEASE_KID, production_date, PRODUCT', 'uniq')}"
FILLED = f"{UNIQUE}, {calendar_join('uniq', 'filled', CARRIED_SMALL)}"
FILLED_P = f"{UNIQUE_P}, {calendar_join('uniq', 'filled', CARRIED_SMALL, by_product=True)}"
REPORTED = ", ".join(
    [RAW_SMALL, dated("raw"), first_of("dated", "LEASE_KID, production_date", "reported")]
)
def filled_all(source: str) -> str:
    return ", ".join(
        [
            TYPED_ALL,
            RECENT,
            dated(source),
            categorized("dated", "cats", True),
            bounded("cats", "cleaned"),
            first_of("cleaned", "LEASE_KID, production_date", "uniq"),
            calendar_join("uniq", "filled", CARRIED_MONTHLY),
        ]
    )


WATER = f"""{FILLED}, watered as (
  select *, cast(case when LEASE_KID % 23 = 0 then -PRODUCTION
                      when month(production_date) = 5 then null
                      else floor(PRODUCTION / 3) end as double) as WATER
  from filled)"""

# Features as expressions over a panel; w is all rows of the entity, or of its product, in order
OWN = {
    "oil": "case when PRODUCT = 'O' then PRODUCTION end",
    "gas": "case when PRODUCT = 'G' then PRODUCTION end",
}
LETTER = {"oil": "O", "gas": "G"}


def windows(by_product: bool = False) -> str:
    series = "LEASE_KID, PRODUCT" if by_product else "LEASE_KID"
    frame = f"(partition by {series} order by production_date rows between"
    return f"""window w as {frame} unbounded preceding and current row),
  w3 as {frame} 2 preceding and current row),
  w6 as {frame} 5 preceding and current row),
  wm as (partition by LEASE_KID, production_date)"""


CUMULATIVE = [
    f"case when PRODUCT = '{LETTER[n]}' and PRODUCTION is null then null else "
    f"sum(case when PRODUCT = '{LETTER[n]}' then PRODUCTION else 0.0 end) over w end as cum_{n}"
    for n in ("oil", "gas")
]
NO_WATER = "cast(null as double) as cum_water"
CUM_WATER = "case when WATER is not null then sum(WATER) over w end as cum_water"
OIL_SUM = f"coalesce(sum({OWN['oil']}) over wm, 0.0)"
GAS_SUM = f"coalesce(sum({OWN['gas']}) over wm, 0.0)"
WATER_SUM = "coalesce(sum(WATER) over wm, 0.0)"
GOR = f"case when {OIL_SUM} <> 0 then {GAS_SUM} / {OIL_SUM} end as gor"
NO_CUT = "cast(null as double) as water_cut"
CUT = f"""case when {OIL_SUM} + {WATER_SUM} <> 0
  and {WATER_SUM} / ({OIL_SUM} + {WATER_SUM}) between 0 and 1
  then {WATER_SUM} / ({OIL_SUM} + {WATER_SUM}) end as water_cut"""
BEFORE = "lag(PRODUCTION) over w"
DECLINE = f"""case when {BEFORE} <> 0 and PRODUCTION is not null
  then greatest(-1.0, least(10.0, (PRODUCTION - {BEFORE}) / {BEFORE})) end as decline_rate"""
ROLLING = [
    f"case when count({OWN[n]}) over w{m} = {m} then avg({OWN[n]}) over w{m} end as rolling_{m}m_{n}"
    for n in ("oil", "gas")
    for m in (3, 6)
]
LAGS = [f"lag({OWN[n]}) over w as lag1_{n}" for n in ("oil", "gas")]
FEATURES = [*CUMULATIVE, NO_WATER, GOR, NO_CUT, DECLINE, *ROLLING, *LAGS]


def add(source: str, expressions: list[str], by_product: bool = False) -> str:
    return f"select *, {', '.join(expressions)} from {source} {windows(by_product)}"


# Manifest
INDEX = f"""idx as (
  select {MONTH_YEAR} as "MONTH-YEAR",
         concat('https://h.example/x?', case when o_custkey % 10 = 9 then 'other=' else 'a=1&f_lc=' end,
                o_custkey) as URL,
         o_orderkey
  from orders),
leases as (
  select "MONTH-YEAR", URL from idx
  where regexp_matches({YEAR}, '^[0-9]+$') and try_cast({YEAR} as bigint) >= {MIN_YEAR}
  qualify row_number() over (partition by URL order by o_orderkey) = 1)"""


def parameter(url: str, name: str) -> str:
    return f"url_decode(nullif(regexp_extract({url}, '[?&]{name}=([^&#]+)', 1), ''))"


LINKS = f"""lease_pages as (
  select cast(page_id as varchar) as lease_id,
         replace(html, 'href="/the', concat('href="/anon_blobber.download?x=1', sign, 'p_file_name=lp', page_id,
                                            '.txt', sign, 'w=')) as html
  from (select *, ['&amp;', '&#38;', '&#x26;'][page_id % 3 + 1] as sign from pages)),
anchors as (
  select lease_id,
         [replace(replace(replace(h, '&amp;', '&'), '&#38;', '&'), '&#x26;', '&') for h in
            regexp_extract_all(
              regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'),
              '(?i)<a\\s[^>]*href="([^"]*)"', 1)
          if contains(h, 'anon_blobber.download')] as hrefs
  from lease_pages),
links as (
  select lease_id, hrefs[1] as link, {parameter("hrefs[1]", "p_file_name")} as file_name from anchors)"""

LANDED = """landed as (
  select concat('lp', doc_id, '.txt') as file_name, n_chars * (doc_id % 2) as length from documents)"""

CAST_ALL = ", ".join(map(_typed, MONTHLY))
ABSENT = ["LEASE", "TOWNSHIP", "LATITUDE", "RANGE_DIR"]
ABSENT_TYPES = {"TOWNSHIP": "bigint", "LATITUDE": "double"}


def _with_absent(name: str) -> str:
    if name in ABSENT:
        return f"cast(null as {ABSENT_TYPES.get(name, 'varchar')}) as {q(name)}"
    return _typed(name)


# Oil files have no LEASE column, and no URL column either
SCANNED = ", ".join(
    f"case when o_orderstatus <> 'O' then {sql} end as LEASE" if name == "LEASE" else f"nullif({sql}, '') as {q(name)}"
    for name, sql in RAW_TEXT.items()
    if name != "URL"
)
LEASE_GONE = f"{RAW_ALL}, raw as (select {{}}, o_orderkey from raw_text)".format(
    ", ".join(
        "case when PRODUCT <> 'O' then LEASE end as LEASE" if n == "LEASE" else _typed(n) for n in MONTHLY
    )
)
SIDES = f"""{FILLED},
{first_of("dated", "LEASE_KID, production_date", "reported")},
sides as (
  select r.LEASE_KID, r.production_date, r.PRODUCT, r.PRODUCTION as raw_volume, f.PRODUCTION as panel_volume
  from reported r left join filled f
    on r.LEASE_KID = f.LEASE_KID and r.production_date = f.production_date)"""
SPAN = """select LEASE_KID, min(production_date) as first_date, max(production_date) as last_date,
  count(*) as rows,
  cast(date_diff('month', min(production_date), max(production_date)) + 1 as bigint) as months
from uniq group by LEASE_KID"""
FALLS = f"""{REPORTED},
wet as (
  select * exclude (o_orderkey), case when month(production_date) % 4 = 0 then -1.0 else PRODUCTION end as WATER
  from reported),
totals as (select *, {", ".join(CUMULATIVE)}, {CUM_WATER} from wet {windows()}),
before as (
  select *, last_value(cum_oil ignore nulls) over p as before_oil,
            last_value(cum_gas ignore nulls) over p as before_gas,
            last_value(cum_water ignore nulls) over p as before_water
  from totals
  window p as (partition by LEASE_KID order by production_date
               rows between unbounded preceding and 1 preceding))
select * exclude (before_oil, before_gas, before_water) from before
where coalesce(cum_oil < before_oil, false) or coalesce(cum_gas < before_gas, false)
   or coalesce(cum_water < before_water, false)
   or (WATER = 0 and cum_water <> coalesce(before_water, 0))
   or (PRODUCT = 'O' and PRODUCTION = 0 and cum_oil <> coalesce(before_oil, 0))
   or (PRODUCT = 'G' and PRODUCTION = 0 and cum_gas <> coalesce(before_gas, 0))"""
PART_CHAIN = ", ".join(
    [
        """raw as (
  select l_partkey as LEASE_KID, concat(month(l_shipdate), '-', year(l_shipdate)) as "MONTH-YEAR",
         case l_linestatus when 'F' then 'G' else l_linestatus end as PRODUCT,
         l_quantity as PRODUCTION, l_orderkey, l_linenumber, l_suppkey
  from lineitem)""",
        dated("raw"),
        bounded("dated", "cleaned"),
        first_of("cleaned", "LEASE_KID, production_date", "uniq", "l_orderkey, l_linenumber, l_suppkey"),
        calendar_join("uniq", "filled", ["MONTH-YEAR", "PRODUCT"]),
    ]
)
DOCUMENT_FILES = """lines as (
  select concat('lp', doc_id, '.txt') as file_name, doc_id % 7 > 0 or doc_id % 5 = 0 as valid,
         len([l for l in string_split(text, chr(10)) if trim(l) <> ''])
         + case when doc_id % 7 = 0 and doc_id % 5 > 0 then 1 else 0 end as n
  from documents)
select concat('lp', c_custkey, '.txt') as file_name, cast(coalesce(n, 0) as bigint) as lines,
       coalesce(n, 0) > 0 as has_content, coalesce(valid, false) as valid_utf8,
       coalesce(n, 0) > 1 as has_rows, coalesce(n > 1 and valid, false) as ok
from customer left join lines on file_name = concat('lp', c_custkey, '.txt')"""

_ALL_FEATURES = f"with {filled_all('recent')} {add('filled', FEATURES)}"
# The first file of each header has a name of its own.
SOURCE_FILES = f"""files as (
  select case o_orderstatus when 'F' then 'lp 1.txt' when 'O' then 'lp%20+é.txt' else 'lp[1].txt' end as name,
         o_orderkey // {ROWS_PER_FILE} as file from orders),
named as (select name, file, min(file) over (partition by name) as first from files)
select case when file = first then name else 'part' end as source_file, count(*) as rows from named group by 1"""
DICTIONARY = """select concat('C', p_partkey) as "column",
  case when p_partkey % 5 = 0 then '' else concat('"', p_name, '", ', p_type) end as description,
  ['int', 'float', 'string', 'categorical', 'decimal'][p_partkey % 5 + 1] as dtype,
  case when p_partkey % 3 = 0 then 'no' else 'yes' end as nullable,
  case when p_partkey % 5 = 3 then concat(p_brand, '|', p_type) else '' end as categories,
  ['bigint', 'double', 'string', 'string', null][p_partkey % 5 + 1] as spark_type
from part"""
WET_ROLLING = [
    f"case when count(WATER) over w{m} = {m} then avg(WATER) over w{m} end as rolling_{m}m_water" for m in (3, 6)
]
MANIFEST = f"""{INDEX}, {LINKS}, {LANDED},
  ids as (select URL, {parameter('URL', 'f_lc')} as lease_id from leases)
  select URL, lease_id, 'https://h.example/month?f_lc=' || lease_id as page_url, link, file_name,
         case when lease_id is null then 'bad_url' when file_name is null then 'no_link'
              when {{landed}} then 'landed' else 'pending' end as status
  from ids left join links using (lease_id)"""

# Cells that can't be read, rows that are too long, files that lack the lease, dates beyond the last year.
BAD_CELLS = f"""cells as (
  select o_orderkey as k, {PRODUCT} as product, o_orderstatus,
         case when o_orderkey % 71 = 0 then 'none' when o_orderkey % 73 <> 0 then '1' end as lease,
         o_orderkey % 67 = 0 as half, case when o_orderkey % 79 = 0 then '5-12345' else {MONTH_YEAR} end as my
  from orders),
marked as (
  select *, product = 'O' and k % 31 = 0 as long, regexp_matches(string_split(my, '-')[-1], '^[0-9]+$')
         and try_cast(string_split(my, '-')[-1] as bigint) >= {MIN_YEAR} as kept
  from cells),
faults as (
  select 'ingest' as stage, 'LEASE_KID' as "column", 'is required and absent' as reason, null as text
  from (select distinct k // {ROWS_PER_FILE} from cells where product = 'P')
  union all
  select 'ingest', null, 'row with more cells than its header', 'more,' from marked where long
  union all
  select 'ingest', 'LEASE_KID', 'needs a number', lease from marked
  where product in ('G', 'O') and not long and kept and (lease is null or lease = 'none')
  union all
  select 'ingest', 'SECTION', 'is not a whole number', '7.5' from marked
  where product in ('G', 'O') and not long and kept and half
  union all
  select 'transform', 'MONTH-YEAR', 'no date has the year', my from marked
  where product in ('G', 'O') and not long and lease = '1' and not half and my = '5-12345')"""


def check(name: str, condition: str, source: str = "marked") -> str:
    key = "min({'entity': LEASE_KID::text, 'month': production_date::text}) filter (bad)"
    return f"""select '{name}' as "check", count(*) filter (bad) as offences, {key}.entity || ' ' || {key}.month as example
  from (select *, coalesce({condition}, false) as bad from {source})"""


REPORT = f"""{REPORTED},
totals as (select *, {", ".join(CUMULATIVE)} from reported {windows()}),
marked as (
  select *, lag(production_date) over o as before, last_value(cum_oil ignore nulls) over p as before_oil,
         last_value(cum_gas ignore nulls) over p as before_gas
  from totals
  window o as (partition by LEASE_KID order by production_date),
         p as (partition by LEASE_KID order by production_date rows between unbounded preceding and 1 preceding))
""" + "\nunion all\n".join(
    [
        check("bounds", "PRODUCTION < 0 or isnan(PRODUCTION) or isinf(PRODUCTION)"),
        check("units", "PRODUCT = 'O' and PRODUCTION > 50000"),
        check("category", "coalesce(PRODUCT not in ('O', 'G'), false) or coalesce(TWN_DIR not in ('S', 'N'), false)"),
        check("complete", "production_date <> before + interval 1 month"),
        check(
            "monotone",
            "coalesce(cum_oil < before_oil, false) or coalesce(cum_gas < before_gas, false)"
            " or coalesce(PRODUCT = 'O' and PRODUCTION = 0 and cum_oil <> coalesce(before_oil, 0), false)"
            " or coalesce(PRODUCT = 'G' and PRODUCTION = 0 and cum_gas <> coalesce(before_gas, 0), false)",
        ),
    ]
)

ORACLES: dict[str, str] = {
    "rejected_rows": f"with {BAD_CELLS} select *, count(*) as rows from faults group by all",
    "stage_report": f"with {REPORT}",
    "committed_versions": f"with {FILLED} select LEASE_KID, count(*) as rows from filled group by 1",
    "lease_index": f"with {INDEX} select * from leases",
    "raw_scan": f"select {SCANNED} from orders",
    "union_files": f"""with {RAW_ALL}
        select LEASE_KID, case when PRODUCT <> 'O' then LEASE end as LEASE,
               case when PRODUCT <> 'O' then URL end as URL, count(*) as rows
        from raw_text group by all""",
    "source_files": f"with {SOURCE_FILES}",
    "dictionary_scan": DICTIONARY,
    "clamped_files": "select o_custkey as LEASE_KID, count(*) as rows, 10 as files from orders group by 1",
    "entity_layout": f"with {UNIQUE} select LEASE_KID, count(*) as rows, 1::bigint as files from uniq group by 1",
    "entity_lookup": f"""with {UNIQUE} select LEASE_KID, count(*) as rows, min(production_date) as first_date,
        max(production_date) as last_date, case when LEASE_KID % 20 = 0 then count(*) end as looked_up
        from uniq group by 1""",
    "sized_files": f"with {UNIQUE} select LEASE_KID, count(*) as rows from uniq group by 1",
    "schema_drift": """select unnest([
        'LEASE_KID: int64' || chr(10) || 'PRODUCT: string' || chr(10) || 'PRODUCTION: double',
        'LEASE_KID: int64' || chr(10) || 'PRODUCTION: double']) as schema""",
    "stage_roundtrip": f"with {RAW_SMALL} select * from raw",
    "file_integrity": f"with {DOCUMENT_FILES}",
    "typed_cast": f"with {RAW_ALL} select {CAST_ALL} from raw_text",
    "absent_column": f"with {RAW_ALL} select {', '.join(map(_with_absent, MONTHLY))} from raw_text",
    "canonical_select": f"with {RAW_ALL} select {names(MONTHLY)} from raw_text",
    "year_filter": f"with {RAW_SMALL}, {RECENT} select * from recent",
    "parse_date": f"""with {RAW_SMALL}, ahead as (
          select * replace (case when o_orderkey % 103 = 0 then regexp_replace("MONTH-YEAR", '-1', '-2', 'g')
                                 else "MONTH-YEAR" end as "MONTH-YEAR") from raw),
        {dated('ahead')} select * from dated""",
    "cast_categoricals": f"with {RAW_SMALL}, {categorized('raw', 'cats', False)} select * from cats",
    "validate_bounds": f"with {RAW_SMALL}, {bounded('raw', 'bounded')} select * from bounded",
    "clean_rows": f"with {CLEANED} select * from cleaned",
    "sorted_panel": f"with {UNIQUE} select * exclude (o_orderkey) from uniq",
    "deduplicate": f"with {UNIQUE} select * from uniq",
    "deduplicate_product": f"with {UNIQUE_P} select * from uniq",
    "entity_span": f"with {UNIQUE} {SPAN}",
    "fill_date_gaps": f"with {FILLED} select * from filled",
    "fill_date_gaps_marked": f"""with {UNIQUE},
        {calendar_join('uniq', 'filled', CARRIED_SMALL, zero_fill=False, mark=True)} select * from filled""",
    "fill_date_gaps_product": f"with {FILLED_P} select * from filled",
    "cumulative": f"with {UNIQUE} {add('(select * exclude (o_orderkey) from uniq)', [*CUMULATIVE, NO_WATER])}",
    "cumulative_water": f"with {WATER} {add('watered', [*CUMULATIVE, CUM_WATER])}",
    "ratio_features": f"with {FILLED_P} {add('filled', [GOR, NO_CUT], True)}",
    "ratio_entity": f"""with {CLEANED}, sums as (
          select LEASE_KID, coalesce(sum({OWN['oil']}), 0.0) as oil, coalesce(sum({OWN['gas']}), 0.0) as gas
          from cleaned group by LEASE_KID)
        select LEASE_KID, PRODUCT, PRODUCTION, o_orderkey, case when oil <> 0 then gas / oil end as gor, {NO_CUT}
        from cleaned join sums using (LEASE_KID)""",
    "water_cut": f"with {WATER} {add('watered', [GOR, CUT])}",
    "decline_rate": f"with {FILLED} {add('filled', [DECLINE])}",
    "rolling": f"with {UNIQUE} {add('(select * exclude (o_orderkey) from uniq)', ROLLING)}",
    "rolling_water": f"with {WATER} {add('watered', [*ROLLING, *WET_ROLLING, *LAGS, 'lag(WATER) over w as lag1_water'])}",
    "lag_features": f"with {FILLED} {add('filled', LAGS)}",
    "features_all": f"with {FILLED} {add('filled', FEATURES)}",
    "features_product": f"with {FILLED_P} {add('filled', FEATURES, True)}",
    "part_features": f"with {PART_CHAIN} {add('filled', FEATURES)}",
    "lease_ids": f"""with {INDEX}, firsts as (
          select * from idx qualify row_number() over (partition by URL order by o_orderkey) = 1)
        select "MONTH-YEAR", URL, {parameter('URL', 'f_lc')} as lease_id from firsts""",
    "page_parameters": f"""select page_id, {parameter('url', 'page')} as page,
        {parameter('url', 'utm_source')} as utm_source from pages""",
    "download_links": f"with {LINKS} select * from links",
    "pending_files": f"""with {LINKS}, {LANDED}
        select lease_id, file_name from links
        where file_name is not null and file_name not in (select file_name from landed where length > 0)""",
    "lease_manifest": "with "
    + MANIFEST.format(landed="file_name in (select file_name from landed where length > 0)"),
    "acquire_job": "with " + MANIFEST.format(landed="false"),
    "ingest_job": f"with {LEASE_GONE}, {RECENT} select * exclude (o_orderkey) from recent",
    "transform_job": f"with {filled_all('raw')} select * from filled",
    "features_job": f"with {FILLED} {add('filled', FEATURES)}",
    "all_stages": _ALL_FEATURES,
    "whole_run": _ALL_FEATURES,
    "dq_bounds": f"""with {RAW_SMALL}, more as (
          select *, cast(case when o_orderkey % 41 = 0 then -1.5 when o_orderkey % 5 > 0 then 2 end as double) as gor,
                 cast(case o_orderkey % 37 when 0 then 1.5 when 1 then -0.5 when 2 then 1 when 3 then null else 0 end
                      as double) as water_cut
          from raw)
        select * from more where PRODUCTION < 0 or gor < 0 or water_cut < 0 or water_cut > 1""",
    "dq_units": f"with {RAW_SMALL} select * from raw where PRODUCT = 'O' and PRODUCTION > 50000",
    "dq_monotone": f"with {FALLS}",
    "dq_complete": f"with {UNIQUE}, spans as ({SPAN}) select * from spans where rows <> months",
    "dq_zero_null": f"""with {SIDES}
        select *, case when raw_volume = 0 then 'zero_lost' else 'null_to_zero' end as finding from sides
        where (raw_volume = 0 and panel_volume is distinct from 0) or (raw_volume is null and panel_volume = 0)""",
    "dq_spot": f"""with {SIDES}
        select *, case when raw_volume is null or raw_volume < 0 or (PRODUCT = 'O' and raw_volume > 50000)
                       then coalesce(panel_volume, 0) = 0
                       else panel_volume is not distinct from raw_volume end as agrees
        from sides
        where (LEASE_KID + year(production_date) * 12 + month(production_date)) % 3 = 0""",
    "dq_rowcount": f"""with {UNIQUE}
        select 'before' as measure, count(*) as rows from cleaned
        union all select 'after', count(*) from uniq
        union all select 'repeated_keys', count(*) from (
          select 1 from cleaned group by LEASE_KID, production_date having count(*) > 1)""",
    "file_order": f"""with {CLEANED}
        select LEASE_KID, production_date from cleaned
        qualify lag(production_date) over (partition by LEASE_KID order by o_orderkey) >= production_date""",
    "dq_category": f"""with {RAW_SMALL} select * from raw
        where PRODUCT not in ('O', 'G') or TWN_DIR not in ('S', 'N')""",
}
