"""The same cleaning queries as plain SQL for the DuckDB oracle, where SQL can say them."""

from reconspark.operators.units import MEASURES, PACKS

_KEY = r"upper(regexp_replace(regexp_replace({n}, '^=', ''), '[''\"]', '', 'g'))"
#: Half width and without white space: NFKC of these keys and amounts is their half-width form.
_NARROW = r"regexp_replace(translate({c}, '{wide}', '{narrow}'), '[\s\x{{a0}}\x{{3000}}]', '', 'g')"
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_ASCII = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")
_NONE = "('', '-', '--', 'N/A', 'NULL', '无')"


def _narrow(c: str) -> str:
    return _NARROW.format(c=c, wide=_WIDE, narrow=_ASCII)


def _typed(c: str) -> str:
    return _KEY.format(n=_narrow(c))


def _blank(c: str) -> str:
    return f"({c} is null or upper({_narrow(c)}) in {_NONE})"


def _amount(c: str) -> str:
    bare = rf"regexp_replace({_narrow(c)}, '[¥元,()]', '', 'g')"
    return f"round(try_cast({bare} as double) * case when {c} like '%(%)%' then -1 else 1 end, 6)"


_P4_BOTH = " union all ".join(
    f"select a.k as platform_order_no, '{f}' as difference from a join b using (k) where abs(cast(a.{f} as decimal(28, 6)) - cast(b.{f} as decimal(28, 6))) > 0.01 or (a.{f} is null) <> (b.{f} is null)"
    for f in ("wdt_amount", "bill_receivable", "bill_cash")
)
P4 = f"""
with a as (select {_typed('platform_order_no')} as k, wdt_amount, bill_receivable, bill_cash from v4_order_bill_recon where not {_blank('platform_order_no')}),
b as (select {_typed('platform_order_no')} as k, {', '.join(f"max({_amount(f)}) as {f}" for f in ("wdt_amount", "bill_receivable", "bill_cash"))}
      from v4_order_bill_copy where not {_blank('platform_order_no')} group by 1)
select k as platform_order_no, 'only_recon' as difference from a where k not in (select k from b)
union all select k, 'only_copy' from b where k not in (select k from a)
union all {_P4_BOTH}
"""

_FM = "left join (select source_file, file_month from export_file) x using (source_file)"
P7_ROWS = f"""
select 'huice_detail.reconcile_id' as ref_field, row_id, file_month, upper(trim(reconcile_id)) not in (select upper(trim(reconcile_id)) from huice_current_amount where reconcile_id is not null) as missing
from huice_detail {_FM} where not {_blank('reconcile_id')}
union all
select 'huice_current_amount.reconcile_id', row_id, file_month, upper(trim(reconcile_id)) not in (select upper(trim(reconcile_id)) from huice_detail where reconcile_id is not null)
from huice_current_amount {_FM} where not {_blank('reconcile_id')}
union all
select 'wdt_order_item_stage.material_key', row_id, file_month, upper(trim(material_key)) not in (
    select upper(trim(sap_code)) from wdt_product_sap where sap_code is not null union all select 'SKU:' || upper(trim(product_code)) from wdt_product_sap where product_code is not null)
from wdt_order_item_stage {_FM} where not {_blank('material_key')}
"""
P7 = f"select ref_field, row_id, file_month from ({P7_ROWS}) where missing"
P7_REPORT = f"select ref_field, file_month, count(*) as reference_count, cast(sum(case when missing then 1 else 0 end) as bigint) as orphan_count from ({P7_ROWS}) group by 1, 2"

_DAYS = ["%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%d-%b-%Y", "%d %b %Y", "%b %d, %Y", "%Y年%m月%d日", "%Y年%m月%d", "%d %B %Y", "%B %d, %Y"]
_CLOCKS = ["", " %H:%M:%S", " %H:%M:%S.%f", "T%H:%M:%S", "T%H:%M:%S.%f", " %H:%M", "T%H:%M", " %I:%M:%S %p", " %I:%M %p", " %H时%M分%S秒"]


def _formats(order: str) -> str:
    xy = {"dmy": "%d{0}%m{0}%Y", "mdy": "%m{0}%d{0}%Y"}[order]
    days = _DAYS + [xy.format(s) for s in "-/."]
    return "[" + ", ".join(f"'{d}{c}'" for d in days for c in _CLOCKS) + ", '%Y%m%d']"


_OFFSETS = {"Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "BST": 60, "CET": 60, "CEST": 120, "EST": -300, "EDT": -240, "CDT": -300, "PST": -480, "PDT": -420, "MST": -420, "MDT": -360, "AEST": 600, "AEDT": 660, "CST": 480, "JST": 540, "HKT": 480, "IST": 330}
_ABBR = "case upper(z) " + " ".join(f"when '{k}' then {v}" for k, v in _OFFSETS.items()) + " end"
#: The moment that a local time names in a zone: of two the earlier, in a gap by the offset before the change.
_AT = "case when timezone({z}, timezone({z}, {t}) - interval 1 hour) = {t} then timezone({z}, {t}) - interval 1 hour else timezone({z}, {t}) end"
_FIELDS = (("wdt_orders_file", "ship_time"), ("huice_detail", "business_date"), ("huice_detail", "period_end"))
_TEXTS = " union all ".join(f"select '{t}' as table_name, row_id, '{f}' as field_name, {f} as raw, source_file from {t}" for t, f in _FIELDS)
P1 = rf"""
with r as (select * from ({_TEXTS}) where not {_blank('raw')}),
t as (select table_name, row_id, field_name, tz_name, date_order, trim(regexp_replace(translate(raw, '{_WIDE}', '{_ASCII}'), '[\s\x{{a0}}\x{{3000}}]+', ' ', 'g')) as t from r left join export_file using (source_file)),
c as (select *, regexp_extract(t, '^(.*:\d\d(?:\.\d+)?)\s*((?:UTC|GMT)?\s?[+-]\d{{1,2}}(?::?\d\d)?|[A-Z][A-Za-z]+/[A-Za-z_/+-]+|\[[A-Za-z_/+-]+\]|[A-Za-z]{{1,4}})$', ['body', 'zone']) as m from t),
b as (select *, case when m.zone <> '' and upper(m.zone) not in ('AM', 'PM') then m.body else t end as body, case when m.zone <> '' and upper(m.zone) not in ('AM', 'PM') then trim(m.zone, '[] ') end as z from c),
n as (select *, regexp_matches(body, '\b24[:时]0?0([:分]0?0秒?)?$|^\d{{8}}240000$') as late from b),
p as (select *, case when late then regexp_replace(regexp_replace(body, '24([:时]0?0([:分]0?0秒?)?)$', '00\1'), '240000$', '000000') when regexp_matches(body, '上午|下午') then regexp_replace(body, '(上午|下午)\s*(.*)$', '\2') || case when body like '%上午%' then ' AM' else ' PM' end else body end as s from n),
l as (select *, case when regexp_full_match(s, '\d{{14}}') then try_strptime(s, '%Y%m%d%H%M%S') when regexp_full_match(s, '\d{{12}}') then try_strptime(s, '%Y%m%d%H%M') when date_order = 'mdy' then try_strptime(s, {_formats('mdy')}) else try_strptime(s, {_formats('dmy')}) end + case when late then interval 1 day else interval 0 day end as local,
    case when regexp_full_match(s, '[2-6]\d{{4}}(\.\d+)?') then timestamp '1899-12-30' + to_microseconds(cast(round(cast(s as decimal(30, 15)) * 86400000) as bigint) * 1000) end as sheet from p),
i as (select *, case when regexp_full_match(s, '\d{{13}}') then make_timestamp(cast(s as bigint) * 1000) when regexp_full_match(s, '\d{{10}}') then make_timestamp(cast(s as bigint) * 1000000)
    when sheet is not null then {_AT.format(z='tz_name', t='sheet')} at time zone 'UTC'
    when z is null then {_AT.format(z='tz_name', t='local')} at time zone 'UTC'
    when z like '%/%' then {_AT.format(z='z', t='local')} at time zone 'UTC'
    when regexp_matches(z, '[+-]\d') then local - to_minutes(case when z like '%-%' then -1 else 1 end * (cast(regexp_extract(z, '[+-](\d{{1,2}})', 1) as integer) * 60 + coalesce(try_cast(regexp_extract(z, '[+-]\d{{1,2}}:?(\d\d)$', 1) as integer), 0)))
    else local - to_minutes({_ABBR}) end as moment from l)
select table_name, row_id, field_name, cast(floor((epoch_us(moment) + 500) / 1000.0) as bigint) as utc_ms from i where moment is not null
"""

#: The units and packs of operators/units.py as rows; sizes multiply up from the measure to the outermost pack.
_NAMES = [(a, u, b, f) for u, b, f, names in MEASURES for a in names] + [(a, u, None, None) for u, names in PACKS for a in names]
_ALIASES = ", ".join(f"('{a}', '{u}', {'null' if b is None else repr(b)}, {'null' if f is None else f + '::double'})" for a, u, b, f in _NAMES)
_ANY = "|".join(sorted((a.replace(".", r"\.") for a, *_ in _NAMES), key=lambda a: -len(a)))
_PACK = "|".join(sorted((a for a, _, b, _ in _NAMES if b is None), key=lambda a: -len(a)))
P6 = rf"""
with a(alias, unit, base, f) as (values {_ALIASES}),
s as (select row_number() over () as sid, upper(trim(sap_code)) as sap, upper(trim(product_code)) as product, base_unit, lower({_narrow('spec_text')}) as t from material_spec where base_unit is not null),
c as (select *, regexp_extract(t, '(?:计量单位:?|默认单位|\(按)({_ANY})', 1) as count_alias, regexp_replace(t, '[,;。]*(计量单位|默认单位|\(按).*$', '') as body from s),
n as (select *, unnest(regexp_extract_all(body, '(\d+(?:\.\d+)?)({_ANY})', 1)) as k, unnest(regexp_extract_all(body, '(\d+(?:\.\d+)?)({_ANY})', 2)) as u, generate_subscripts(regexp_extract_all(body, '(\d+(?:\.\d+)?)({_ANY})', 1), 1) as i from c),
v as (select sid, i, cast(k as double) as k, unit, base, f from n join a on alias = u where not (k = '1' and unit = '箱')),
o as (select sid, k, unit, f, case when outward then i else top - i end as j from (select v.*, max(i) over (partition by sid) as top, first_value(base) over (partition by sid order by i) is not null as outward from v)),
g as (select *, row_number() over (partition by sid order by j) as level from o),
m as (select *, product(k * coalesce(f, 1.0)) over (partition by sid order by level rows unbounded preceding) as upto from g where sid in (select sid from g where level = 1 and f is not null)),
sizes as (select sid, unit, lag(upto) over (partition by sid order by level) as amount from m),
outer_unit as (select c.sid, a.unit, (select max_by(upto, level) from m where m.sid = c.sid) as amount from c join a on alias = coalesce(nullif(regexp_extract(body, '^(?:每|1)({_PACK})', 1), ''), nullif(regexp_extract(body, '/({_ANY})$', 1), ''))),
z as (select sid, unit, first(amount) as amount from (select sid, unit, amount from sizes where amount is not null union all select sid, unit, amount from outer_unit where amount is not null) group by 1, 2),
keys as (select sap as key, sid from s where sap is not null union all select 'SKU:' || product, min(sid) from s where product is not null group by product having count(distinct coalesce(t, '')) = 1),
r as (select row_id, base_unit, count_alias, quantity, case when {_blank('unit')} then '' else lower({_narrow('unit')}) end as u, sid from wdt_order_item_stage i join keys on key = upper(trim(material_key)) join c using (sid) where quantity is not null and not isnan(quantity) and (unit is null or unit <> base_unit)),
p as (select *, case when regexp_matches(u, '\d') then cast(regexp_extract(u, '(\d+(?:\.\d+)?)[^\d/()装]+', 1) as double) else 1.0 end as k,
    case when u = '' then count_alias when regexp_matches(u, '\d') then regexp_extract(u, '\d+(?:\.\d+)?([^\d/()装]+)', 1) when length(u) > 1 then regexp_replace(u, '装$', '') else u end as word from r),
w as (select p.*, a.unit, a.base, a.f, z.amount from p join a on a.alias = p.word left join z on z.sid = p.sid and z.unit = a.unit),
x as (select row_id, base_unit, quantity * k * case when base = base_unit then f else amount end * 1000 as milli from w)
select row_id, base_unit, cast(sign(milli) * floor(abs(milli) + 0.5 + 1e-6) as bigint) as milli_quantity from x where milli is not null
"""

ORACLES = {"p1_found": P1, "p4_found": P4, "p6_found": P6, "p4_summary": f"select difference, count(*) as row_count from ({P4}) group by 1", "p7_found": P7, "p7_report": P7_REPORT}
