"""Lookup, cleaning, date and name queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.catalog import roles
from panelspark.catalog.registry import register
from panelspark.catalog.roles import AS_OF, member_id
from panelspark.functions import dates as D
from panelspark.functions import names as N
from panelspark.functions import text as X
from panelspark.operators import lookup

_SITES = """
    SELECT c_custkey, 'Site ' || n_name || ' / ' || c_mktsegment || ' 2024' AS site_text
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _site_texts(spark, sf_dir):
    customer, nation = roles.table(spark, sf_dir, "customer"), roles.table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey",
        F.concat(F.lit("Site "), "n_name", F.lit(" / "), "c_mktsegment", F.lit(" 2024")).alias("site_text"),
    )


def _contained_sql(pick: str) -> str:
    return f"""
    , texts AS ({_SITES})
    SELECT c_custkey, coalesce(CAST(hit AS VARCHAR), site_text) AS clinic_label
    FROM texts LEFT JOIN (
      SELECT site_text, {pick}(id) AS hit
      FROM (SELECT DISTINCT site_text FROM texts) JOIN clinics
           ON is_active = 1 AND contains(site_text, clinic_key)
      GROUP BY ALL) USING (site_text)"""


def _map_sites(spark, sf_dir, last):
    active = lookup.active_values(roles.clinics(spark, sf_dir), "clinic_key", "id")
    mapped = lookup.map_contained(
        _site_texts(spark, sf_dir), "site_text", active, "clinic_key", "id", "clinic_id", last=last
    )
    return mapped.select("c_custkey", lookup.label(F.col("clinic_id"), F.col("site_text")).alias("clinic_label"))


@register("map_first_contains", _contained_sql("min"), ("clinics",))
def map_first_contains(spark, sf_dir):
    return _map_sites(spark, sf_dir, last=False)


@register("map_last_contains", _contained_sql("max"), ("clinics",))
def map_last_contains(spark, sf_dir):
    return _map_sites(spark, sf_dir, last=True)


def _many_keys(spark, sf_dir):
    """Four digits of each part's key, some missing; their values and order, some missing too."""
    part = roles.table(spark, sf_dir, "part")
    digits = F.right(F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit(4))
    return part.select(
        F.when(F.col("p_brand") != "Brand#3", digits).alias("code"),
        F.when(F.col("p_type") != "PROMO", F.concat("p_name", F.lit(" "), "p_partkey")).alias("name"),
        F.when(F.col("p_size") != 7, F.col("p_retailprice") * 1000 + F.col("p_partkey")).alias("place"),
    )


@register(
    "map_contained_many",
    """
    WITH codes AS (
      SELECT CASE WHEN p_brand <> 'Brand#3' THEN right(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 4) END AS code,
             CASE WHEN p_type <> 'PROMO' THEN p_name || ' ' || p_partkey END AS name,
             CASE WHEN p_size <> 7 THEN p_retailprice * 1000 + p_partkey END AS place
      FROM part),
    hits AS (SELECT c_custkey, code, name, place FROM customer JOIN codes ON contains(c_name, code)),
    firsts AS (SELECT c_custkey, name FROM hits QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY place NULLS FIRST, code) = 1),
    lasts AS (SELECT c_custkey, name FROM hits QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY place DESC NULLS LAST, code DESC) = 1)
    SELECT c_custkey, f.name AS first_name, l.name AS last_name
    FROM customer LEFT JOIN firsts f USING (c_custkey) LEFT JOIN lasts l USING (c_custkey)""",
)
def map_contained_many(spark, sf_dir):
    """A map of thousands of keys in the scan of the texts."""
    texts, codes = roles.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), _many_keys(spark, sf_dir)
    labelled = lookup.map_contained(texts, "c_name", codes, "code", "name", "first_name", order="place")
    return lookup.map_contained(labelled, "c_name", codes, "code", "name", "last_name", order="place", last=True).drop("c_name")


def _measure_texts(spark, sf_dir):
    return roles.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(
            F.split_part("o_orderpriority", F.lit("-"), F.lit(2)), F.lit(" "), F.year("o_orderdate")
        ).alias("measure_text"),
    )


def _map_measures(spark, sf_dir):
    active = lookup.active_values(roles.measures_map(spark, sf_dir), "measure", "id")
    return lookup.map_trimmed(_measure_texts(spark, sf_dir), "measure_text", active, "measure", "id", "measure_id")


_MEASURE_TEXTS = """
    , texts AS (SELECT o_orderkey, split_part(o_orderpriority, '-', 2) || ' ' || year(o_orderdate) AS measure_text
                FROM orders)"""


@register(
    "map_trimmed_exact",
    f"""{_MEASURE_TEXTS}
    SELECT o_orderkey, coalesce(CAST(id AS VARCHAR), measure_text) AS measure_label
    FROM texts LEFT JOIN measures_map ON is_active = 1
         AND measure = left(measure_text, greatest(length(measure_text) - 5, 0))""",
    ("measures_map",),
)
def map_trimmed_exact(spark, sf_dir):
    return _map_measures(spark, sf_dir).select(
        "o_orderkey", lookup.label(F.col("measure_id"), F.col("measure_text")).alias("measure_label")
    )


@register(
    "mapped_measures_only",
    f"""{_MEASURE_TEXTS}
    SELECT o_orderkey, id AS measure_id
    FROM texts JOIN measures_map ON is_active = 1
         AND measure = left(measure_text, greatest(length(measure_text) - 5, 0))""",
    ("measures_map",),
)
def mapped_measures_only(spark, sf_dir):
    return lookup.mapped_only(_map_measures(spark, sf_dir), "measure_id").select("o_orderkey", "measure_id")


@register(
    "unmapped_measures",
    f"""{_MEASURE_TEXTS}
    SELECT DISTINCT measure_text FROM texts
    WHERE left(measure_text, greatest(length(measure_text) - 5, 0)) NOT IN
          (SELECT measure FROM measures_map WHERE is_active = 1)""",
    ("measures_map",),
)
def unmapped_measures(spark, sf_dir):
    return lookup.unmapped(_map_measures(spark, sf_dir), "measure_id", "measure_text")


@register(
    "active_lookup",
    "SELECT county, max(id) AS id FROM clinics WHERE is_active = 1 GROUP BY county",
    ("clinics",),
)
def active_lookup(spark, sf_dir):
    return lookup.active_values(roles.clinics(spark, sf_dir), "county", "id")


@register(
    "rename_cast_project",
    """
    SELECT to_base(c_custkey, 36, 10) AS cin, CAST(c_nationkey AS INTEGER) AS clinic_id,
           CAST(c_nationkey AS VARCHAR) AS clinic_text, c_name AS last_name,
           coalesce(NULLIF(c_mktsegment, 'HOUSEHOLD'), '') AS first_name
    FROM customer""",
)
def rename_cast_project(spark, sf_dir):
    named = {"c_custkey": "cin", "c_nationkey": "clinic_id", "c_mktsegment": "first_name", "c_name": "last_name"}
    raw = roles.table(spark, sf_dir, "customer").withColumnsRenamed(named)
    return raw.select(
        member_id("cin").alias("cin"),
        F.col("clinic_id").cast("int").alias("clinic_id"),
        F.col("clinic_id").cast("string").alias("clinic_text"),
        "last_name",
        X.fill_empty(X.null_tokens(F.col("first_name"), ["HOUSEHOLD"])).alias("first_name"),
    )


def _phone_sql(text: str) -> str:
    return f"""CASE length({text})
        WHEN 10 THEN regexp_replace({text}, '([0-9]{{3}})([0-9]{{3}})([0-9]{{4}})', '\\1-\\2-\\3')
        WHEN 7 THEN regexp_replace({text}, '([0-9]{{3}})([0-9]{{4}})', '\\1-\\2')
        ELSE '' END"""


_STRIPPED = r"regexp_replace(coalesce(phone_raw, 'nan'), '\W+', '', 'g')"
_SHEET_PHONE = _phone_sql("coalesce(phone_raw, 'nan')")


@register(
    "phone_formats",
    f"""
    SELECT cin, {_phone_sql(_STRIPPED)} AS roster_phone, NULLIF({_SHEET_PHONE}, '') AS sheet_phone
    FROM contacts""",
    ("contacts",),
)
def phone_formats(spark, sf_dir):
    raw = F.col("phone_raw")
    return roles.contacts(spark, sf_dir).select(
        "cin",
        X.phone(raw).alias("roster_phone"),
        X.null_tokens(X.phone(raw, punctuation=False)).alias("sheet_phone"),
    )


_ADDRESS = """replace(trim((CASE WHEN line1 = '-$' THEN '' ELSE line1 END)
                           || (CASE WHEN line2 IS NULL OR line2 = '-' THEN '' ELSE line2 END)), '''', '''''')"""


@register(
    "address_format",
    f"""
    SELECT cin, {_ADDRESS} AS address,
           replace(trim({_ADDRESS} || ' :: ' || coalesce(city, '') || ' ~ ' || coalesce(state, '')
                        || ' | ' || zip_code), '''', '''''') AS full_address
    FROM contacts""",
    ("contacts",),
)
def address_format(spark, sf_dir):
    c = F.col
    return roles.contacts(spark, sf_dir).select(
        "cin",
        X.address(c("line1"), c("line2")).alias("address"),
        X.full_address(c("line1"), c("line2"), c("city"), c("state"), c("zip_code")).alias("full_address"),
    )


@register(
    "flag_decode",
    """
    SELECT cin, CASE sex_code WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE sex_code END AS roster_sex,
           CASE WHEN sex_code = 'F' THEN 'Female' ELSE 'Male' END AS sheet_sex,
           CASE WHEN mark = '*' THEN 'TRUE' ELSE 'FALSE' END AS new_member_text,
           CASE WHEN mark = 'Y' THEN 1 ELSE 0 END AS new_member,
           CASE WHEN n_name LIKE '%Capitated%' OR n_name LIKE '%CCS%' THEN 0 ELSE 1 END AS special_flag
    FROM contacts""",
    ("contacts",),
)
def flag_decode(spark, sf_dir):
    return roles.contacts(spark, sf_dir).select(
        "cin",
        X.sex_roster(F.col("sex_code")).alias("roster_sex"),
        X.sex_sheet(F.col("sex_code")).alias("sheet_sex"),
        X.flag_text(F.col("mark"), "*").alias("new_member_text"),
        X.flag(F.col("mark"), "Y").alias("new_member"),
        X.special_member(F.col("n_name")).alias("special_flag"),
    )


@register(
    "quoted_names",
    "SELECT cin, replace(line1, '''', '''''') AS quoted FROM contacts",
    ("contacts",),
)
def quoted_names(spark, sf_dir):
    return roles.contacts(spark, sf_dir).select("cin", X.double_quotes(F.col("line1")).alias("quoted"))


@register(
    "period_key",
    """
    SELECT o_orderkey, printf('%s_%02d-%d', o_orderstatus, month(o_orderdate), year(o_orderdate)) AS period
    FROM orders""",
)
def period_key(spark, sf_dir):
    day = F.col("o_orderdate")
    return roles.table(spark, sf_dir, "orders").select(
        "o_orderkey", D.period_key(F.col("o_orderstatus"), F.month(day), F.year(day)).alias("period")
    )




@register(
    "period_from_text",
    """
    SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS file_month,
           CAST(year(o_orderdate) AS INTEGER) AS file_year, left(monthname(o_orderdate), 3) AS abbreviation,
           CAST(year(o_orderdate) + 100 AS VARCHAR) AS site_part,
           CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS period
    FROM orders""",
)
def period_from_text(spark, sf_dir):
    day, name = F.col("o_orderdate"), F.col("name")
    months = F.array(*[F.lit(m) for m in D.MONTHS])
    named = roles.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit("Plan-"), (F.year(day) + 100).cast("string"), F.lit("_1_"),
            F.get(months, F.month(day) - 1), F.lit("-"), F.year(day).cast("string"), F.lit(".xls"),
        ).alias("name"),
        F.concat(F.lit("site_"), F.date_format(day, "MM-yyyy"), F.lit(".txt")).alias("processed"),
    )
    return named.select(
        "o_orderkey",
        D.month_number(name).alias("file_month"),
        D.file_year(name).alias("file_year"),
        D.month_abbreviation(D.month_number(name)).alias("abbreviation"),
        D.name_part(D.name_part(name, "-", 1), "_", 0).alias("site_part"),
        D.name_period(F.col("processed")).alias("period"),
    )


@register(
    "date_parse",
    """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS us_day,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS iso_day, strftime(o_orderdate, '%m/%d/%Y') AS printed,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders""",
)
def date_parse(spark, sf_dir):
    day = F.col("o_orderdate")
    texts = roles.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(day, "MM/dd/yyyy").alias("us"), F.date_format(day, "yyyy-MM-dd").alias("iso")
    )
    parsed = D.parse_date(F.col("us"))
    return texts.select(
        "o_orderkey",
        parsed.alias("us_day"),
        D.parse_date(F.col("iso")).alias("iso_day"),
        D.us_date(parsed).alias("printed"),
        F.year(parsed).alias("year"),
        F.month(parsed).alias("month"),
    )


@register(
    "null_tokens",
    """
    SELECT doc_id, CASE WHEN piece NOT IN ('', 'None', 'null', 'NA', 'N/A', 'nan', 'NULL') THEN piece END AS value,
           coalesce(CASE WHEN piece <> '' THEN piece END, '') AS clean_value
    FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN '' WHEN lang = 'fr' THEN 'None' WHEN lang = 'de' THEN 'null'
                              ELSE source END AS piece FROM documents)""",
)
def null_tokens(spark, sf_dir):
    lang = F.col("lang")
    piece = F.when(lang == "en", "").when(lang == "fr", "None").when(lang == "de", "null").otherwise(F.col("source"))
    return roles.table(spark, sf_dir, "documents").select(
        "doc_id",
        X.null_tokens(piece).alias("value"),
        X.fill_empty(X.null_tokens(piece, [""])).alias("clean_value"),
    )


def _token_sql(name: str, index: int) -> str:
    return f"trim(lower(string_split({name}, ' ')[{index}]))"


@register(
    "name_tokens",
    f"""
    SELECT cin, {_token_sql('first_name', 1)} AS first_1, {_token_sql('first_name', 2)} AS first_2,
           {_token_sql('first_name', 3)} AS first_3, {_token_sql('last_name', 1)} AS last_1,
           {_token_sql('last_name', 2)} AS last_2
    FROM members""",
    ("members",),
)
def name_tokens(spark, sf_dir):
    first, last = F.col("first_name"), F.col("last_name")
    return roles.match_members(spark, sf_dir).select(
        "cin",
        *[N.name_token(first, i).alias(f"first_{i + 1}") for i in range(3)],
        *[N.name_token(last, i).alias(f"last_{i + 1}") for i in range(2)],
    )


@register(
    "name_normalize",
    """
    SELECT cin, replace(trim(lower(last_name)), '-', ' ') AS member_last, trim(lower(last_name)) AS patient_last,
           left(trim(lower(last_name)), 1) AS initial,
           trim(lower(first_name)) || ' ' || replace(trim(lower(last_name)), '-', ' ') AS straight,
           replace(trim(lower(last_name)), '-', ' ') || ' ' || trim(lower(first_name)) AS flipped
    FROM members""",
    ("members",),
)
def name_normalize(spark, sf_dir):
    first, last = N.normal_name(F.col("first_name")), N.normal_name(F.col("last_name"))
    patient = N.normal_name(F.col("last_name"), hyphens=False)
    return roles.match_members(spark, sf_dir).select(
        "cin",
        last.alias("member_last"),
        patient.alias("patient_last"),
        F.left(patient, F.lit(1)).alias("initial"),
        N.full_name(first, last).alias("straight"),
        N.full_name(last, first).alias("flipped"),
    )


@register(
    "member_age",
    f"""
    SELECT cin, CAST(date_sub('year', dob, DATE '{AS_OF}') AS INTEGER) AS age FROM customers""",
    ("customers",),
)
def member_age(spark, sf_dir):
    return roles.customers(spark, sf_dir).select("cin", D.age(F.col("dob"), F.lit(AS_OF)).alias("age"))
