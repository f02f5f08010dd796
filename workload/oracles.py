"""The SQL each query must equal, for DuckDB over the same tables.

The statements share common table expressions: the test tables as text cells (``*_cells``),
the flat table, and the model's tables built from them.
"""

from __future__ import annotations

from dimloom.plans import tables as t

ACTIVE_AFTER = "2001-06-30"
RERUN_FROM = "1996-01-01"
MICROSECONDS = "%Y-%m-%d %H:%M:%S.%f"
SECONDS = "%Y-%m-%d %H:%M:%S"
DAYS_ONLY = "%Y-%m-%d"
WHITE_SPACE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
OPTIONAL_KEYS = ("prescription_id", "lab_order_id")


def text(column: str) -> str:
    return f"cast({column} as varchar)"


def money(column: str) -> str:
    return f"cast(cast({column} as decimal(12,2)) as varchar)"


def moment(column: str) -> str:
    return f"strftime({column}, '{MICROSECONDS}')"


def to_microsecond(cell: str) -> str:
    return f"try_strptime({cell}, '{MICROSECONDS}')"


def parsed(cell: str) -> str:
    return f"try_strptime({cell}, ['{MICROSECONDS}', '{SECONDS}', '{DAYS_ONLY}'])"


def amount(cell: str) -> str:
    return f"try_cast({cell} as decimal(10,2))"


def seconds(value: str) -> str:
    return f"strftime({value}, '{SECONDS}')"


def not_blank(cell: str) -> str:
    return f"({cell} is not null and trim({cell}, {WHITE_SPACE}) <> '')"


def filled(cells: tuple[str, ...]) -> str:
    """Replacements that make blank cells null."""
    return ", ".join(f"case when {not_blank(c)} then {c} end as {c}" for c in cells)


def survivor(keys: tuple[str, ...], newest: tuple[str, ...], rest: tuple[str, ...]) -> str:
    order = ", ".join(f"{c} desc nulls last" for c in (*newest, *rest))
    return f"qualify row_number() over (partition by {', '.join(keys)} order by {order}) = 1"


def commas(columns: tuple[str, ...]) -> str:
    return ", ".join(columns)


ORDER_COLUMNS = f"""
    {text("o_custkey")} as patient_id,
    o_orderpriority as visit_type,
    o_orderpriority as insurance_id,
    o_orderstatus as insurance_payer_name,
    {text("o_orderkey")} as insurance_policy_number,
    cast(null as varchar) as insurance_group_number,
    o_orderpriority as insurance_plan_type,
    {text("o_orderkey")} as billing_id,
    {money("o_totalprice")} as billing_total_charge,
    case o_orderstatus when 'F' then {money("o_totalprice")} when 'O' then '0.00' end
        as billing_amount_paid,
    {moment("o_orderdate")} as billing_date,
    o_orderstatus as billing_payment_status"""

CUSTOMER_COLUMNS = f"""
    split_part(c_name, '#', 1) as patient_first_name,
    split_part(c_name, '#', 2) as patient_last_name,
    cast(null as varchar) as patient_date_of_birth,
    c_mktsegment as patient_gender,
    c_name as patient_address_line1,
    cast(null as varchar) as patient_address_line2,
    n.n_name as patient_city,
    r_name as patient_state,
    {text("c_nationkey")} as patient_zip,
    cast(null as varchar) as patient_phone,
    cast(null as varchar) as patient_email,
    {text("r_regionkey")} as treatment_code,
    r_name as treatment_desc"""

PART_COLUMNS = f"""
    p_brand as doctor_name,
    p_type as doctor_title,
    {text("p_size")} as doctor_department,
    case when p_type <> 'ECONOMY' then {text("p_partkey")} end as prescription_id,
    p_name as prescription_drug_name,
    {text("p_size")} || 'mg' as prescription_dosage,
    p_type as prescription_frequency,
    {text("p_size")} as prescription_duration_days"""

SUPPLIER_COLUMNS = "clinic.n_name as clinic_name, s_name as room_number"

EVENT_COLUMNS = f"""
    case event_type when 'signup' then '' when 'error' then null else {text("event_id")} end
        as lab_order_id,
    event_type as lab_test_code,
    {text("user_id")} as lab_name,
    {money('"value"')} as lab_result_value,
    props as lab_result_units,
    {moment("ts")} as lab_result_date"""

LINE_COLUMNS = f"""
    {text("l_orderkey")} || '-' || {text("l_linenumber")} as visit_id,
    {moment("l_shipdate")} as visit_datetime,
    l_returnflag as primary_diagnosis_code,
    l_linestatus as primary_diagnosis_desc,
    case when l_returnflag <> 'N' then l_returnflag end as secondary_diagnosis_code,
    case when l_returnflag <> 'N' then l_linestatus end as secondary_diagnosis_desc"""

WITH_NATION = """
    left join nation n on c_nationkey = n.n_nationkey
    left join region on n.n_regionkey = r_regionkey"""

WITH_CLINIC = "left join nation clinic on s_nationkey = clinic.n_nationkey"

STAR = f"""lineitem
    left join orders on l_orderkey = o_orderkey
    left join customer on o_custkey = c_custkey
    left join part on l_partkey = p_partkey
    left join supplier on l_suppkey = s_suppkey
    {WITH_NATION} {WITH_CLINIC}"""

VISIT_COLUMNS = ",".join(
    [LINE_COLUMNS, ORDER_COLUMNS, CUSTOMER_COLUMNS, PART_COLUMNS, SUPPLIER_COLUMNS]
)

# Keys of which some are blanked, each by another remainder of the visit id's length and end.
BLANKED = ("patient_id", "insurance_id", "billing_id", "visit_id")


def cut(cell: str, by: str) -> str:
    """Times of three precisions, by the last digit of another cell."""
    last = f"cast(right({by}, 1) as integer) % 3"
    return (
        f"case {last} when 1 then substr({cell}, 1, 19) "
        f"when 2 then substr({cell}, 1, 10) else {cell} end"
    )


def blanked(key: str) -> str:
    order = f"cast(split_part(visit_id, '-', 1) as bigint) % 50 - {10 * BLANKED.index(key)}"
    return (
        f"case {order} when 0 then null when 1 then '' when 2 then '  ' "
        f"when 3 then chr(9) when 4 then concat(' ', chr(10)) else {key} end"
    )


CELLS = f"""
order_cells as (select {moment("o_orderdate")} as visit_datetime, {ORDER_COLUMNS} from orders),
customer_cells as (
    select {text("c_custkey")} as patient_id, {CUSTOMER_COLUMNS} from customer {WITH_NATION}),
part_cells as (select {PART_COLUMNS} from part),
supplier_cells as (select {SUPPLIER_COLUMNS} from supplier {WITH_CLINIC}),
event_cells as (select {EVENT_COLUMNS} from events),
line_cells as (select {LINE_COLUMNS} from lineitem),
line_billing as (
    select {text("l_orderkey")} as billing_id, l_returnflag as insurance_id,
        {money("l_extendedprice")} as billing_total_charge,
        {money("l_quantity")} as billing_amount_paid,
        {moment("l_shipdate")} as billing_date, l_linestatus as billing_payment_status
    from lineitem),
visits as (select {VISIT_COLUMNS}, {text("l_orderkey")} as lab_order_id from {STAR}),
flat as (
    select {VISIT_COLUMNS}, {EVENT_COLUMNS}
    from {STAR} left join events on l_orderkey = event_id),
mixed_times as (
    select * replace (
        {cut("visit_datetime", "visit_id")} as visit_datetime,
        {cut("billing_date", "billing_id")} as billing_date)
    from flat),
blank_keys as (
    select * replace (
        {", ".join(f"{blanked(key)} as {key}" for key in BLANKED)})
    from flat),
messy as (
    select {text("o_orderkey")} as visit_id,
        case o_orderpriority when '1-URGENT' then {moment("o_orderdate")}
            when '2-HIGH' then {seconds("o_orderdate")}
            when '3-MEDIUM' then 'on ' || {moment("o_orderdate")}
            when '4-NOT SPECIFIED' then '  '
            else {moment("o_orderdate")} || '7' end as visit_datetime,
        case o_orderpriority when '1-URGENT' then {moment("o_orderdate")}
            when '2-HIGH' then strftime(o_orderdate, '%Y-%m-%d')
            when '3-MEDIUM' then 'soon'
            when '5-LOW' then {seconds("o_orderdate")} end as lab_result_date,
        case o_orderstatus when 'F' then {money("o_totalprice")}
            when 'O' then '123456' || {money("o_totalprice")} else 'n/a' end
            as billing_total_charge,
        case o_orderstatus when 'F' then {money("o_totalprice")} || '5' when 'O' then '1e2' end
            as billing_amount_paid,
        case o_orderstatus when 'F' then {text("o_custkey")}
            when 'O' then {text("o_custkey")} || '.5' else '' end
            as prescription_duration_days
    from orders)"""

BILLING_VALUES = f"""billing_id, insurance_id,
    {amount("billing_total_charge")} as billing_total_charge,
    {amount("billing_amount_paid")} as billing_amount_paid,
    {parsed("billing_date")} as billing_date, billing_payment_status"""

DAYS = (
    "case when regexp_full_match(trim(prescription_duration_days), '[+-]?[0-9]+') "
    "then try_cast(prescription_duration_days as integer) end"
)


def newest(source: str, columns: tuple[str, ...], keys: tuple[str, ...], timed: bool) -> str:
    """The latest visit's row per key; sources without visits have only their own values."""
    seen = (parsed("visit_datetime"),) if timed else ()
    rest = tuple(c for c in columns if c not in keys)
    return f"select {commas(columns)} from {source} {survivor(keys, seen, rest)}"


def numbered(spec: t.Numbered, source: str) -> str:
    order = ", ".join(f"{k} nulls first" for k in spec.keys)
    kept = " and ".join(not_blank(k) for k in spec.keys) if spec.drop_blank else "true"
    return (
        f"select row_number() over (order by {order}) as {spec.id_name}, {commas(spec.keys)} "
        f"from (select distinct {commas(spec.keys)} from {source} where {kept})"
    )


def lookups(specs: tuple[t.Numbered, ...]) -> str:
    """Joins that find the ids; a dimension without null tuples cannot match any."""
    return " ".join(
        f"left join {spec.name} on "
        + " and ".join(f"v.{k} is not distinct from {spec.name}.{k}" for k in spec.keys)
        for spec in specs
    )


def billing(source: str) -> str:
    return f"select distinct {BILLING_VALUES} from {source}"


def lab_orders(source: str) -> str:
    rest = t.LAB_ORDER[1:-1]
    return f"""select {commas(t.LAB_ORDER[:-1])},
        try_cast(lab_result_date as timestamp) as lab_result_date
    from {source} where {not_blank("lab_order_id")}
    {survivor(("lab_order_id",), ("lab_result_date",), rest)}"""


def prescriptions(source: str, timed: bool) -> str:
    rest = (*t.PRESCRIPTION[1:-1], DAYS)
    seen = (parsed("visit_datetime"),) if timed else ()
    return f"""select {commas(t.PRESCRIPTION[:-1])}, {DAYS} as prescription_duration_days
    from {source} where {not_blank("prescription_id")}
    {survivor(("prescription_id",), seen, rest)}"""


def model_tables(flat: str | None, torn: str = "") -> str:
    """All eleven tables, from a flat table or from each subject's own cells. ``torn`` is what
    torn rows of its file add to DimLocation."""

    def source(own: str) -> str:
        return "keyed" if flat else own

    sources = {
        "DimProvider": "part_cells",
        "DimLocation": "supplier_cells",
        "DimPrimaryDiagnosis": "line_cells",
        "DimSecondaryDiagnosis": "line_cells",
        "DimTreatment": "customer_cells",
    }
    rest = tuple(c for c in t.FACT_VISIT if c not in ("visit_id", "visit_datetime"))
    plain = tuple(c for c in rest if c not in {s.id_name for s in t.NUMBERED})
    plain = tuple(c for c in plain if c not in OPTIONAL_KEYS)
    ctes = {
        "last_visits": f"""select patient_id, max(cast({parsed("visit_datetime")} as date))
            as last_visit_date from {source("order_cells")} group by patient_id""",
        "patient_rows": newest(source("customer_cells"), t.PATIENT, ("patient_id",), flat),
        "DimPatient": f"""select {commas(tuple("p." + c for c in t.PATIENT))},
            case when last_visit_date > date '{ACTIVE_AFTER}' then 'Active' else 'Inactive' end
                as patient_status
            from patient_rows p left join last_visits l on p.patient_id = l.patient_id""",
        "DimInsurance": newest(
            source("order_cells"), t.COLUMNS["DimInsurance"], ("insurance_id", "patient_id"), True
        ),
        "DimBilling": billing(source("order_cells")),
        **{s.name: numbered(s, source(sources[s.name])) for s in t.NUMBERED},
        "DimPrescription": prescriptions(source("part_cells"), flat),
        "DimLabOrder": lab_orders(source("event_cells")),
        "visit_rows": f"""select v.visit_id, {parsed("v.visit_datetime")} as visit_datetime,
            {commas(tuple("v." + c for c in plain))},
            {commas(tuple(s.id_name for s in t.NUMBERED))},
            {", ".join(f"case when {not_blank('v.' + c)} then v.{c} end as {c}"
                       for c in OPTIONAL_KEYS)}
            from {source("visits")} v {lookups(t.NUMBERED)}""",
        "FactVisit": f"""select {commas(t.FACT_VISIT)} from visit_rows
            {survivor(("visit_id",), ("visit_datetime",), rest)} or visit_id is null""",
    }
    if flat:
        keys = tuple(dict.fromkeys(c for own in t.NATURAL_KEYS.values() for c in own))
        ctes = {"keyed": f"select * replace ({filled(keys)}) from {flat}", **ctes}
    ctes["DimLocation"] += torn
    return ",\n".join(f"{name} as ({body})" for name, body in ctes.items())


def on_cells(body: str) -> str:
    return f"with {CELLS}\n{body}"


def on_model(body: str, flat: str | None = None, torn: str = "") -> str:
    return f"with {CELLS},\n{model_tables(flat, torn)}\n{body}"


def published(name: str, table: str) -> str:
    shown = (seconds(c) + f" as {c}" if t.MOMENTS.get(name) == c else c for c in t.COLUMNS[name])
    return f"select {', '.join(shown)} from {table}"


def row_counts() -> str:
    return " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {name}"
        for name in t.PRIMARY_KEYS
    )


def null_counts() -> str:
    return " union all ".join(
        f"select '{name}' as table_name, '{key}' as key_column, "
        f"count(*) filter ({key} is null) as null_rows from {name}"
        for name, keys in t.PRIMARY_KEYS.items()
        for key in keys
    )


def input_profile(flat: str = "flat") -> str:
    def of_table(name: str, keys: tuple[str, ...]) -> str:
        filled = " and ".join(not_blank(k) for k in keys)
        per_key = f"select count(*) as copies from {flat} where {filled} group by {commas(keys)}"
        return f"""select '{name}' as table_name, (select count(*) from {flat}) as row_count,
            (select count(*) from {flat} where not ({filled})) as blank_rows,
            (select count(*) from ({per_key})) as distinct_keys,
            (select count(*) from ({per_key}) where copies > 1) as repeated_keys"""

    return " union all ".join(of_table(n, k) for n, k in t.NATURAL_KEYS.items())


def missing_keys() -> str:
    return " union all ".join(
        f"select '{key}' as fk_column, {text(key)} as missing_key from "
        f"(select {key} from FactVisit except select {key} from {link.dimension})"
        for link in t.LINKS
        for key in link.columns[:1]
    )


def null_links() -> str:
    return " union all ".join(
        f"select visit_id, '{link.columns[0]}' as fk_column from FactVisit "
        f"where {link.columns[0]} is null"
        for link in t.LINKS
    )


def held(link: t.Link) -> str:
    """The test whether fact row f is found in the link's dimension d."""
    return " and ".join(f"f.{c} = d.{c}" for c in link.columns)


def unused_keys() -> str:
    return " union all ".join(
        f"select distinct '{link.dimension}' as dimension, "
        f"{text(link.columns[0])} as unused_key, "
        f"{text(link.columns[1]) if link.columns[1:] else 'cast(null as varchar)'} as second_part "
        f"from {link.dimension} d "
        f"where not exists (select 1 from FactVisit f where {held(link)})"
        for link in t.LINKS
    )


def link_numbers(link: t.Link) -> dict[str, str]:
    """Each number of a link's profile as a scalar query."""
    dimension = link.dimension
    some_null = " or ".join(f"f.{c} is null" for c in link.columns)
    orphans = (
        f"from FactVisit f where not ({some_null}) "
        f"and not exists (select 1 from {dimension} d where {held(link)})"
    )
    keys = commas(tuple(f"f.{c}" for c in link.columns))
    own = commas(link.columns)
    return {
        "empty_links": f"select count(*) from FactVisit f where {some_null}",
        "orphan_keys": f"select count(*) from (select distinct {keys} {orphans})",
        "orphan_rows": f"select count(*) {orphans}",
        "unused_keys": f"select count(*) from (select distinct {own} from {dimension}) d "
        f"where not exists (select 1 from FactVisit f where {held(link)})",
        "rows_before": "select count(*) from FactVisit",
        "rows_after": f"select count(*) from FactVisit f left join {dimension} d on {held(link)}",
    }


def links_summary(columns: tuple[str, ...] = ()) -> str:
    def of_link(link: t.Link) -> str:
        numbers = link_numbers(link)
        shown = ", ".join(f"({numbers[c]}) as {c}" for c in columns or numbers)
        return f"select '{link.dimension}' as dimension, {shown}"

    return " union all ".join(of_link(link) for link in t.LINKS)


def report() -> str:
    lines = []
    for name, keys in t.PRIMARY_KEYS.items():
        some_null = " or ".join(f"{k} is null" for k in keys)
        own = commas(keys)
        numbers = {
            "row_count": f"select count(*) from {name}",
            "null_rows": f"select count(*) from {name} where {some_null}",
            "duplicate_keys": f"select count(*) from (select {own} from {name} "
            f"group by {own} having count(*) > 1)",
        }
        lines += [(check, name, ",".join(keys), sql) for check, sql in numbers.items()]
    for link in t.LINKS:
        lines += [
            (check, link.dimension, ",".join(link.columns), sql)
            for check, sql in link_numbers(link).items()
        ]
    scalar = [
        f"select '{check}' as check_name, '{table}' as table_name, "
        f"'{column}' as column_name, ({sql}) as value"
        for check, table, column, sql in lines
    ]
    status = (
        "select 'status_' || lower(patient_status), 'DimPatient', 'patient_status', count(*) "
        "from DimPatient group by patient_status"
    )
    return " union all ".join([*scalar, status])


def torn_lines(torn: dict[str, int]) -> str:
    """The report's lines on torn rows, none of them left out."""
    return " union all ".join(
        f"select '{check}', '{name}', '*', {count}"
        for name in t.COLUMNS
        for check, count in (("torn_rows", torn.get(name, 0)), ("rows_left_out", 0))
    )


def quoted_text(separator: str, *more: str) -> str:
    """What the text with quoted fields holds, by the remainder of the order's key."""
    key = text("o_orderkey")
    name = f"""case o_orderkey % 4 when 0 then o_orderstatus
        when 2 then o_orderstatus || '{separator}' || chr(10) || chr(10) || '"' || {key}
            || '"{separator}'
        else o_orderstatus || chr(10) || 'rest-' || {key} end"""
    cells = [
        f"{text('o_custkey')} as patient_id",
        f"'n' || {key} as patient_first_name",
        f"{name} as patient_last_name",
        f"{key} as visit_id",
        *more,
    ]
    return f"select {', '.join(cells)} from orders"


def months_of(visit_type: str) -> str:
    moment_text = seconds("visit_datetime")
    return f"""select strftime(visit_datetime, '%Y-%m') as visit_month,
        {visit_type} as visit_type, count(*) as visits,
        min({moment_text}) as first_visit, max({moment_text}) as last_visit
        from FactVisit group by 1, 2"""


def running_total(latest: str) -> str:
    return f"""select billing_month, month_total,
        cast(sum(month_total) over (order by billing_month nulls first
            rows between unbounded preceding and current row) as decimal(28,2)) as running_total
        from (select date_trunc('month', billing_date) as billing_month,
            cast(sum(billing_total_charge) as decimal(28,2)) as month_total
            from ({latest}) group by 1)"""


ONE_PER_ID = f"""select {BILLING_VALUES} from line_billing
    {survivor(
        ("billing_id",),
        (parsed("line_billing.billing_date"),),
        (
            "line_billing.insurance_id",
            amount("line_billing.billing_total_charge"),
            amount("line_billing.billing_amount_paid"),
            "line_billing.billing_payment_status",
        ),
    )}"""

# Lines with fields left out, a field too many, and a line break, from the orders.
TORN_TEXT = f"""
    select {text("o_custkey")} as patient_id, 'n' || {text("o_orderkey")} as patient_first_name,
        case when o_orderkey % 4 = 1 then null else o_orderstatus end as patient_last_name,
        case when o_orderkey % 4 in (1, 3) then null else {text("o_orderkey")} end as visit_id,
        o_orderkey % 4 <> 0 as is_torn
    from orders
    union all
    select 'rest-' || {text("o_orderkey")}, null, null, null, true from orders
        where o_orderkey % 4 = 3"""


def gender_counts(attribute: str) -> str:
    return f"""select {attribute}, patient_gender, count(*) as visits
        from FactVisit f left join DimProvider p on f.provider_id = p.provider_id
            left join DimPatient d on f.patient_id = d.patient_id
        group by {attribute}, patient_gender"""


REJECTS = " union all ".join(
    f"select visit_id, '{column}' as column_name, {column} as raw_value, '{reason}' as reason "
    f"from messy where {not_blank(column)} and {value} is null"
    for column, reason, value in (
        ("visit_datetime", "not a timestamp", parsed("visit_datetime")),
        ("lab_result_date", "not a timestamp", "try_cast(lab_result_date as timestamp)"),
        ("billing_total_charge", "not an amount", amount("billing_total_charge")),
        ("billing_amount_paid", "not an amount", amount("billing_amount_paid")),
        ("prescription_duration_days", "not a whole number", f"({DAYS})"),
    )
)

# Two of the five customer segments, in the place of genders; the rest are "other".
SEGMENTS = ("AUTOMOBILE", "BUILDING")

LINE_REST = (
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)

FLAT_TEXT = ", ".join(
    # The text form keeps no difference between blank and null.
    "nullif(lab_order_id, '') as lab_order_id" if c == "lab_order_id" else c
    for columns in (
        t.PATIENT, t.VISIT, t.INSURANCE, t.BILLING, t.PROVIDER, t.LOCATION,
        t.PRIMARY_DIAGNOSIS, t.SECONDARY_DIAGNOSIS, t.TREATMENT, t.PRESCRIPTION, t.LAB_ORDER,
    )
    for c in columns
)

# Query name -> table, for the tables built from the flat frame.
FROM_FLAT = {
    "dim_patient_from_flat": "DimPatient",
    "dim_insurance_from_flat": "DimInsurance",
    "dim_billing_from_flat": "DimBilling",
    "dim_provider_from_flat": "DimProvider",
    "dim_location_from_flat": "DimLocation",
    "dim_primary_diagnosis_from_flat": "DimPrimaryDiagnosis",
    "dim_secondary_diagnosis_from_flat": "DimSecondaryDiagnosis",
    "dim_treatment_from_flat": "DimTreatment",
    "dim_prescription_from_flat": "DimPrescription",
    "dim_lab_order_from_flat": "DimLabOrder",
    "fact_visit_from_flat": t.FACT,
}

ORACLES: dict[str, str] = {
    **{query: on_model(published(name, name), flat="flat") for query, name in FROM_FLAT.items()},
    **{
        f"{query}_mixed_times": on_model(published(name, name), flat="mixed_times")
        for query, name in (
            ("dim_patient", "DimPatient"), ("dim_billing", "DimBilling"), ("fact_visit", t.FACT),
        )
    },
    "parse_rejects_mixed_times": on_cells("select 0 as rejects"),
    "torn_rows": on_cells(TORN_TEXT),
    "line_breaks": on_cells(quoted_text(",", "o_orderkey % 4 = 3 as is_torn")),
    "line_breaks_left_out": on_cells(f"""{quoted_text(";")} where o_orderkey % 4 <> 3
        union all select null, null, null,
        {text("coalesce(sum(case when o_orderkey % 4 = 3 then 3 end), 0)")} from orders"""),
    "blank_keys_profile": on_cells(input_profile("blank_keys")),
    "blank_keys_pk_nulls": on_model(null_counts(), flat="blank_keys"),
    "blank_keys_fk_nulls": on_model(null_links(), flat="blank_keys"),
    "blank_keys_report": on_model(report(), flat="blank_keys"),
    "blank_keys_fact": on_model(published(t.FACT, t.FACT), flat="blank_keys"),
    "billing_running_total_conflicts": on_cells(running_total(ONE_PER_ID)),
    "dim_patient_status": on_model("select * from DimPatient"),
    "dim_insurance": on_model("select * from DimInsurance"),
    "dim_billing": on_model(published("DimBilling", "DimBilling")),
    "dim_billing_lines": on_cells(published("DimBilling", f"({billing('line_billing')})")),
    "billing_one_per_id": on_cells(
        published(
            "DimBilling",
            f"({ONE_PER_ID})",
        )
    ),
    "dim_provider": on_model("select * from DimProvider"),
    "dim_location": on_model("select * from DimLocation"),
    "dim_primary_diagnosis": on_model("select * from DimPrimaryDiagnosis"),
    "dim_secondary_diagnosis": on_model("select * from DimSecondaryDiagnosis"),
    "dim_treatment": on_model("select * from DimTreatment"),
    "dim_prescription": on_model("select * from DimPrescription"),
    "dim_lab_order": on_model(published("DimLabOrder", "DimLabOrder")),
    "fact_visit": on_model(published(t.FACT, t.FACT)),
    "visit_survivor": "select * from lineitem "
    + survivor(("l_orderkey", "l_linenumber"), ("l_shipdate",), LINE_REST),
    "distinct_pairs": "select distinct l_partkey, l_suppkey from lineitem",
    "pair_ids_after_append": """with pairs as (
            select l_partkey, l_suppkey, bool_or(l_orderkey % 2 = 0) as was_there
            from lineitem group by l_partkey, l_suppkey)
        select row_number() over (order by was_there desc, l_partkey, l_suppkey) as pair_id,
            l_partkey, l_suppkey from pairs""",
    "part_supplier_ids": """select row_number() over (order by l_partkey, l_suppkey) as pair_id,
        l_partkey, l_suppkey from (select distinct l_partkey, l_suppkey from lineitem)""",
    "last_visits": on_model("select * from last_visits"),
    "parsed_cells": on_cells(f"""select visit_id, {to_microsecond("visit_datetime")} as visit_ts,
        cast({to_microsecond("visit_datetime")} as date) as visit_date,
        coalesce({to_microsecond("visit_datetime")}, try_strptime(visit_datetime, '{SECONDS}'))
            as lenient_ts,
        try_cast(lab_result_date as timestamp) as lab_ts,
        {seconds("try_cast(lab_result_date as timestamp)")} as lab_text,
        {amount("billing_total_charge")} as charge, {amount("billing_amount_paid")} as paid,
        {DAYS} as days from messy"""),
    "parse_rejects": on_cells(
        f"""select column_name, reason, count(*) as rejects from ({REJECTS})
        group by column_name, reason"""
    ),
    "cell_rejects": on_cells(REJECTS),
    "csv_round_trip": on_cells(f"select {FLAT_TEXT} from flat"),
    "normalized_counts": on_model(row_counts(), flat="flat"),
    "model_row_counts": on_model(row_counts()),
    "patient_status_counts": on_model(
        "select patient_status, count(*) as patients from DimPatient group by patient_status"
    ),
    "input_key_profile": on_cells(input_profile()),
    "pk_null_counts": on_model(null_counts()),
    "billing_conflicts": on_cells(
        f"""select billing_id, count(*) as copies from ({billing("line_billing")})
        group by billing_id having count(*) > 1"""
    ),
    "pk_duplicates": """select l_orderkey, l_linenumber, count(*) as copies from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
    "fk_missing_keys": on_model(missing_keys()),
    "lab_missing_keys": on_model(
        "select lab_order_id from FactVisit except select lab_order_id from DimLabOrder"
    ),
    "fk_orphan_rows": on_model("""select visit_id, lab_order_id from FactVisit f
        where lab_order_id is not null and not exists
            (select 1 from DimLabOrder d where d.lab_order_id = f.lab_order_id)"""),
    "fk_null_rows": on_model(null_links()),
    "fk_summary": on_model(links_summary()),
    "dim_unused_keys": on_model(unused_keys()),
    "billing_unused_rows": on_model("""select billing_id, billing_payment_status
        from DimBilling d where not exists
            (select 1 from FactVisit f where f.billing_id = d.billing_id)"""),
    "fanout_check": on_model(links_summary(("rows_before", "rows_after"))),
    "insurance_fan_out": on_model("""select 'insurance_id' as join_columns,
            (select count(*) from FactVisit) as rows_before,
            (select count(*) from FactVisit f left join DimInsurance d
                on f.insurance_id = d.insurance_id) as rows_after
        union all select 'insurance_id,patient_id', (select count(*) from FactVisit),
            (select count(*) from FactVisit f left join DimInsurance d
                on f.insurance_id = d.insurance_id and f.patient_id = d.patient_id)"""),
    "quality_report": on_model(report()),
    "quality_in_batches": on_model(report()),
    "fact_by_month": on_model(months_of("visit_type")),
    "fact_months_rerun": on_model(months_of(f"""case when visit_datetime >= timestamp
        '{RERUN_FROM}' then visit_type else 'first run' end""")),
    "exported_quality": on_model(report() + " union all " + torn_lines({})),
    "exported_quality_torn": on_model(
        report() + " union all " + torn_lines({"DimLocation": 2}),
        torn=" union all values (7777777, 'Torn', null), (7777778, 'Torn', 'Room')",
    ),
    "monthly_visits": on_model("""select date_trunc('month', visit_datetime) as visit_month,
        count(*) as visits from FactVisit group by 1"""),
    "visits_by_location_type": on_model("""select clinic_name, visit_type, count(*) as visits
        from FactVisit f left join DimLocation l on f.location_id = l.location_id
        group by clinic_name, visit_type"""),
    "visits_by_department_gender": on_model(gender_counts("doctor_department")),
    "visits_by_segment_brand": on_model(gender_counts("doctor_name")),
    "gender_columns": on_model(
        "select doctor_department, "
        + ", ".join(
            f"cast(sum(visits) filter (patient_gender = '{g}') as bigint) as {g}"
            for g in SEGMENTS
        )
        + f""", cast(sum(visits) filter (coalesce(patient_gender not in {SEGMENTS}, true))
            as bigint) as other, cast(sum(visits) as bigint) as visits"""
        + f" from ({gender_counts('doctor_department')}) group by doctor_department"
    ),
    "billing_running_total": on_model(running_total("select * from DimBilling")),
    "provider_activity": on_model("""select doctor_name, doctor_department, count(*) as visits
        from FactVisit f left join DimProvider p on f.provider_id = p.provider_id
        group by doctor_name, doctor_department"""),
}
