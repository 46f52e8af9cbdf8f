"""The same queries as SQL over the same tables, for a cross-check in another engine."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from segmart import fixed_values as fv
from segmart.sources import synthetic as syn


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def sql_list(values: Iterable[str | int]) -> str:
    return "[" + ", ".join(quoted(v) if isinstance(v, str) else str(v) for v in values) + "]"


def case_of(column: str, mapping: Mapping[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {quoted(default)} END"


PROVINCES = in_list(fv.PROVINCES)

USERS_RAW = """
users_raw AS (
  SELECT cast(k AS varchar) AS id,
    CASE WHEN k % 97 = 0 THEN '' ELSE c_name END AS name,
    CASE WHEN k % 89 = 0 THEN '' WHEN k % 83 = 0 THEN 'not-an-email'
         WHEN k % 13 = 0 THEN 'user' || cast(k + 1 AS varchar) || '@example.com'
         ELSE 'user' || cast(k AS varchar) || '@example.com' END AS email,
    CASE WHEN k % 7 = 0 THEN '' ELSE '09' || cast(10000000 + k AS varchar) END AS phone,
    CASE k % 11 WHEN 0 THEN 'boy' WHEN 1 THEN 'girl' WHEN 2 THEN 'malee' WHEN 3 THEN ''
         WHEN 4 THEN 'MALE' WHEN 5 THEN 'female' WHEN 6 THEN 'Other' WHEN 7 THEN '??'
         WHEN 8 THEN 'Female' ELSE 'Male' END AS gender,
    CASE k % 23 WHEN 0 THEN 'abc' WHEN 1 THEN '-5' WHEN 2 THEN '999' WHEN 3 THEN ''
         WHEN 4 THEN '0' WHEN 5 THEN '18.7' WHEN 6 THEN ' 42 '
         ELSE cast(k % 120 + 1 AS varchar) END AS age,
    CASE k % 10 WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'An Giang' WHEN 2 THEN ' Cà Mau '
         WHEN 3 THEN 'Atlantis' WHEN 4 THEN '' WHEN 5 THEN 'Gia Lai' WHEN 6 THEN 'Nghệ An'
         WHEN 7 THEN 'Lào Cai' WHEN 8 THEN 'Sơn La' ELSE 'Tây Ninh' END AS address,
    CASE k % 9 WHEN 0 THEN 'Bác sĩ' WHEN 1 THEN 'Y tá' WHEN 2 THEN 'Kỹ sư phần mềm'
         WHEN 3 THEN 'Giáo viên' WHEN 4 THEN '' WHEN 5 THEN 'Nông dân' WHEN 6 THEN 'Kế toán'
         WHEN 7 THEN 'Sinh viên' ELSE 'Công an' END AS occupation,
    CASE k % 19 WHEN 0 THEN '' WHEN 1 THEN '32/13/2025' WHEN 2 THEN '2025-07-04'
         WHEN 3 THEN 'abc' ELSE '04/07/2025' END AS register_date
  FROM (SELECT c_custkey AS k, c_name FROM customer)
)"""

# Documents: blank values are absent, so null.
DOCS = f"""{USERS_RAW},
docs AS (
  SELECT nullif(id, '') AS _id, nullif(name, '') AS name, nullif(email, '') AS email,
    nullif(phone, '') AS phone, nullif(gender, '') AS gender, nullif(age, '') AS age,
    nullif(address, '') AS address, nullif(occupation, '') AS occupation,
    nullif(register_date, '') AS register_date
  FROM users_raw
)"""

WHOLE = r"""CASE WHEN regexp_full_match(trim({0}), '[+-]?[0-9]+(_[0-9]+)*')
      THEN try_cast(replace(trim({0}), '_', '') AS integer) END"""
NICKNAME = "CASE lower(gender) WHEN 'boy' THEN 'Male' WHEN 'girl' THEN 'Female' END"
KNOWN_GENDER = "coalesce(lower(gender) IN ('male', 'female', 'other', 'boy', 'girl'), false)"
CANONICAL_GENDER = f"""coalesce({NICKNAME}, CASE WHEN lower(gender) IN ('male', 'female', 'other')
      THEN upper(gender[1]) || lower(gender[2:]) END)"""
GENDER_AS_TYPED = f"coalesce({NICKNAME}, CASE WHEN {KNOWN_GENDER} THEN gender END)"
GENDER_OR_TAG = f"coalesce({NICKNAME}, CASE WHEN gender IN ('Male', 'Female', 'Other') THEN gender END, 'N/A')"
EMAIL_OR_TAG = r"CASE WHEN regexp_matches(email, '^[^@]+@[^@]+\.[^@]+') THEN email ELSE 'N/A' END"

AGED = f"""{DOCS},
aged AS (
  SELECT *, CASE WHEN whole BETWEEN 1 AND 120 THEN whole END AS good_age
  FROM (SELECT *, {WHOLE.format('age')} AS whole FROM docs)
)"""

STRICT = f"""{AGED},
strict AS (
  SELECT _id, name, email, phone, {CANONICAL_GENDER} AS gender, good_age AS age,
    trim(address) AS address, coalesce(occupation, '') AS occupation
  FROM aged
  WHERE _id IS NOT NULL AND name IS NOT NULL AND email IS NOT NULL
    AND (gender IS NULL OR {KNOWN_GENDER})
    AND (age IS NULL OR good_age IS NOT NULL)
    AND (address IS NULL OR trim(address) IN {PROVINCES})
)"""

SENTINEL = f"""{AGED},
sentinel AS (
  SELECT coalesce(_id, 'None') AS _id, name, email, phone, {GENDER_AS_TYPED} AS gender,
    CASE WHEN age IS NULL THEN -1 ELSE good_age END AS age,
    trim(address) AS address, coalesce(occupation, 'Unkown') AS occupation
  FROM aged
  WHERE {KNOWN_GENDER} AND (age IS NULL OR good_age IS NOT NULL)
    AND (address = 'N/A' OR trim(address) IN {PROVINCES})
)"""

TAGGED = f"""{AGED},
tagged AS (
  SELECT coalesce(_id, 'N/A') AS _id, coalesce(name, 'N/A') AS name, {EMAIL_OR_TAG} AS email,
    coalesce(phone, 'N/A') AS phone, {GENDER_OR_TAG} AS gender,
    coalesce(cast(good_age AS varchar), 'N/A') AS age, good_age,
    CASE WHEN coalesce(address, 'N/A') = 'N/A' THEN 'N/A'
         WHEN trim(address) IN {PROVINCES} THEN trim(address) ELSE 'Invalid' END AS address,
    coalesce(occupation, 'N/A') AS occupation, register_date
  FROM aged
)"""

SURVIVOR = """row_number() OVER (PARTITION BY email
    ORDER BY try_cast(_id AS bigint) NULLS LAST, _id, name, phone, gender, age, address, occupation) = 1"""

AGE_GROUP = """CASE WHEN {0} IS NULL THEN 'Unknown' WHEN {0} > 0 AND {0} < 18 THEN 'Under 18'
    WHEN {0} <= 30 THEN '18-30' WHEN {0} <= 45 THEN '31-45' WHEN {0} <= 60 THEN '46-60'
    ELSE 'Over 60' END"""

USERS = f"""{STRICT},
users AS (SELECT * FROM strict QUALIFY {SURVIVOR})"""

STAR = f"""{USERS},
dim_user AS (SELECT DISTINCT _id AS user_id, name, email FROM users),
dim_address AS (
  SELECT cast(row_number() OVER (ORDER BY province) AS integer) AS address_id, province,
    {case_of('province', fv.PROVINCE_REGION, fv.OTHER)} AS region
  FROM (SELECT DISTINCT address AS province FROM users WHERE address IS NOT NULL)
),
dim_occupation AS (
  SELECT cast(row_number() OVER (ORDER BY occupation_name) AS integer) AS occupation_id,
    occupation_name, {case_of('occupation_name', fv.OCCUPATION_CATEGORY, fv.OTHER)} AS category
  FROM (SELECT DISTINCT occupation AS occupation_name FROM users WHERE occupation IS NOT NULL)
),
dim_age_group AS (
  SELECT cast(row_number() OVER (ORDER BY description) AS integer) AS age_group_id, description
  FROM (SELECT DISTINCT {AGE_GROUP.format('age')} AS description FROM users)
),
fct_user AS (
  SELECT d._id AS user_id, o.occupation_id, a.address_id, g.age_group_id, d.gender
  FROM users d JOIN dim_user u ON d._id = u.user_id
  LEFT JOIN dim_address a ON d.address = a.province
  LEFT JOIN dim_occupation o ON d.occupation = o.occupation_name
  LEFT JOIN dim_age_group g ON {AGE_GROUP.format('d.age')} = g.description
)"""

INSIGHTS = f"""{STAR},
insight_age AS (
  SELECT 'age' AS segment_type, description, count(user_id) AS user_count
  FROM fct_user LEFT JOIN dim_age_group USING (age_group_id) GROUP BY description
),
insight_region AS (
  SELECT 'region' AS segment_type, region AS description, count(user_id) AS user_count
  FROM fct_user LEFT JOIN dim_address USING (address_id) GROUP BY region
),
insight_occupation AS (
  SELECT 'occupation_group' AS segment_type, category AS description, count(user_id) AS user_count
  FROM fct_user LEFT JOIN dim_occupation USING (occupation_id) GROUP BY category
),
insight_gender AS (
  SELECT 'gender' AS segment_type, gender AS description, count(user_id) AS user_count
  FROM fct_user GROUP BY gender
),
segments AS (
  SELECT * FROM insight_age UNION ALL SELECT * FROM insight_region
  UNION ALL SELECT * FROM insight_occupation UNION ALL SELECT * FROM insight_gender
)"""

DATED = f"""{USERS},
dated AS (
  SELECT *, DATE '2025-07-01' + cast(cast(_id AS bigint) % 3 AS integer) AS dt FROM users
)"""

CLEAN = ", ".join(fv.CLEAN_FIELDS)
RAW = ", ".join(fv.RAW_USER_FIELDS)


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def slug_sql(text: str) -> str:
    accented = "".join(fv.FOLDED_LETTERS.values())
    base = "".join(k * len(v) for k, v in fv.FOLDED_LETTERS.items())
    folded = f"translate(lower({text}), '{accented}', '{base}')"
    return f"regexp_replace({folded}, '\\s+', '.', 'g') || '{fv.EMAIL_DOMAIN}'"


def pick_sql(key: str, purpose: str, n: int) -> str:
    multiplier = syn.MULTIPLIERS[purpose]
    return f"((({key} % {syn.PRIME}) * {multiplier} + {multiplier % 9_973}) % {syn.PRIME} % {n})"


def pick_from_sql(key: str, purpose: str, values: tuple) -> str:
    return f"{sql_list(values)}[cast({pick_sql(key, purpose, len(values))} AS integer) + 1]"


def name_sql(key: str) -> str:
    gender = pick_from_sql(key, "gender", fv.GENDERS)
    male, female = fv.MIDDLE_NAMES_MALE, fv.MIDDLE_NAMES_FEMALE
    middle = (
        f"CASE {gender} WHEN 'Male' THEN {pick_from_sql(key, 'middle', male)} "
        f"WHEN 'Female' THEN {pick_from_sql(key, 'middle', female)} "
        f"ELSE {pick_from_sql(key, 'middle', male + female)} END"
    )
    parts = (
        pick_from_sql(key, "family", fv.FAMILY_NAMES), middle,
        pick_from_sql(key, "given_1", fv.GIVEN_NAMES), pick_from_sql(key, "given_2", fv.GIVEN_NAMES),
    )
    return "concat_ws(' ', " + ", ".join(parts) + ")"


SYNTH_USERS = f"""
placed AS (
  SELECT c_custkey AS k, c_custkey % 100 AS place, c_custkey - c_custkey % 100 + {pick_sql('c_custkey', 'source', 68)} AS valid_k
  FROM customer
),
classed AS (
  SELECT *, CASE WHEN place < 68 THEN 'valid' WHEN place < 74 THEN 'bad_gender'
      WHEN place < 80 THEN 'bad_age' WHEN place < 86 THEN 'missing_fields'
      WHEN place < 92 THEN 'duplicate' WHEN place < 98 THEN 'multi_error'
      ELSE 'bad_register_date' END AS error_class
  FROM placed
),
flagged AS (
  SELECT *, CASE error_class
      WHEN 'bad_gender' THEN 1 WHEN 'bad_age' THEN 2 WHEN 'missing_fields' THEN 4
      WHEN 'bad_register_date' THEN 8
      WHEN 'multi_error' THEN CASE {pick_sql('k', 'count', 3)}
        WHEN 0 THEN {pick_from_sql('k', 'subset', syn.PAIRS)}
        WHEN 1 THEN {pick_from_sql('k', 'subset', syn.TRIPLES)} ELSE 15 END
      ELSE 0 END AS bits,
    CASE error_class WHEN 'duplicate' THEN valid_k ELSE k END AS email_k
  FROM classed
),
named AS (
  SELECT *, {name_sql('k')} AS name, {name_sql('email_k')} AS email_name,
    {pick_from_sql('k', 'prefix', fv.PHONE_PREFIXES)}
      || cast(10000000 + {pick_sql('k', 'digits', syn.PRIME)} * 89 AS varchar) AS digits
  FROM flagged
),
synth AS (
  SELECT cast(k AS varchar) AS id, name, {slug_sql('email_name')} AS email,
    digits[1:4] || ' ' || digits[5:7] || ' ' || digits[8:] AS phone,
    CASE WHEN bits & 1 <> 0 THEN {pick_from_sql('k', 'bad_gender', fv.BAD_GENDERS)}
      ELSE {pick_from_sql('k', 'gender', fv.GENDERS)} END AS gender,
    CASE WHEN bits & 2 <> 0 THEN {pick_from_sql('k', 'bad_age', fv.BAD_AGES)}
      ELSE cast({pick_sql('k', 'age', 121)} AS varchar) END AS age,
    CASE WHEN bits & 4 <> 0 AND {pick_sql('k', 'missing', 2)} = 0 THEN ''
      ELSE {pick_from_sql('k', 'address', fv.PROVINCES)} END AS address,
    CASE WHEN bits & 4 <> 0 AND {pick_sql('k', 'missing', 2)} = 1 THEN ''
      ELSE {pick_from_sql('k', 'occupation', fv.OCCUPATIONS)} END AS occupation,
    CASE WHEN bits & 8 <> 0 THEN {pick_from_sql('k', 'bad_date', fv.BAD_REGISTER_DATES)}
      ELSE strftime(DATE '2025-07-04' - cast({pick_sql('k', 'date', fv.REGISTER_DATE_SPAN_DAYS + 1)} AS integer), '%d/%m/%Y')
      END AS register_date,
    error_class
  FROM named
)"""

DAMAGED = """
damaged AS (
  SELECT event_id, CASE event_id % 7 WHEN 1 THEN props[2:] WHEN 2 THEN '[' || props || ']'
      WHEN 3 THEN props || ' xyz' WHEN 4 THEN NULL WHEN 5 THEN props || props
      WHEN 6 THEN '"' || event_type || '"' ELSE props END AS body
  FROM events
)"""

DOCUMENT_JSON = "json_merge_patch('{}'::json, json_object(" + ", ".join(
    f"'{f}', {f}" for f in ("_id", *fv.RAW_USER_FIELDS[1:])
) + "))"

TAG_JSON = """json_merge_patch('{}'::json, json_object('_id', _id, 'name', name, 'email', email,
    'phone', phone, 'gender', gender,
    'age', CASE WHEN good_age IS NULL THEN to_json('N/A') ELSE to_json(good_age) END,
    'address', address, 'occupation', occupation, 'register_date', register_date))"""

RECORD_JSON = "json_object(" + ", ".join(f"'{f}', {f}" for f in fv.CLEAN_FIELDS) + ")"

JSON_TYPE = "CASE {0} WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE {0} END"

ORACLE = {
    # scalars
    "email_slug": with_(
        USERS_RAW,
        "SELECT id, " + slug_sql("concat_ws('  ', name, address, occupation)") + " AS slug FROM users_raw",
    ),
    "phone_format": with_(
        DOCS, "SELECT _id, phone[1:4] || ' ' || phone[5:7] || ' ' || phone[8:] AS phone FROM docs"
    ),
    "register_date_format": """
SELECT c_custkey, strftime(DATE '2025-07-04' - cast(c_custkey % 1826 AS integer), '%d/%m/%Y') AS register_date
FROM customer""",
    "age_bucket": with_(
        USERS_RAW,
        f"SELECT id, age_number AS age, {AGE_GROUP.format('age_number')} AS age_group "
        f"FROM (SELECT id, {WHOLE.format('age')} AS age_number FROM users_raw)",
    ),
    "user_id_cast": with_(
        USERS_RAW,
        "SELECT source_id, try_cast(source_id AS integer) AS user_id FROM (SELECT CASE WHEN "
        "cast(id AS bigint) % 5 = 0 THEN id || '0000000000' ELSE id END AS source_id FROM users_raw)",
    ),
    "province_region": with_(
        DOCS,
        f"SELECT _id, address, {case_of('trim(address)', fv.PROVINCE_REGION, fv.OTHER)} AS region FROM docs",
    ),
    "occupation_category": with_(
        DOCS,
        f"SELECT _id, occupation, {case_of('occupation', fv.OCCUPATION_CATEGORY, fv.OTHER)} AS category FROM docs",
    ),
    # sources and documents
    "synth_users": with_(SYNTH_USERS, "SELECT * FROM synth"),
    "error_class_counts": with_(
        SYNTH_USERS,
        "SELECT error_class, count(*) AS n_rows FROM synth GROUP BY error_class "
        "UNION ALL SELECT 'total', count(*) FROM synth",
    ),
    "doc_build": with_(DOCS, f"SELECT cast({DOCUMENT_JSON} AS varchar) AS document FROM docs"),
    "landing_roundtrip": with_(DOCS, "SELECT * FROM docs"),
    "users_csv_roundtrip": with_(DOCS, f"SELECT {RAW.replace('id', '_id AS id', 1)} FROM docs"),
    "json_parse_guard": with_(
        DAMAGED,
        "SELECT event_id, is_object, CASE WHEN is_object THEN body ->> 'k' END AS k FROM (SELECT event_id, body, "
        "coalesce(json_valid(body) AND CASE WHEN json_valid(body) THEN json_type(body) END = 'OBJECT', false) "
        "AS is_object FROM damaged)",
    ),
    "record_to_json": with_(USERS, f"SELECT _id, cast({RECORD_JSON} AS varchar) AS record FROM users"),
    "schema_census": with_(
        DOCS,
        f"SELECT key, {JSON_TYPE.format('json_type(doc, key)')} AS json_type, count(*) AS n_docs "
        f"FROM (SELECT doc, unnest(json_keys(doc)) AS key FROM (SELECT {DOCUMENT_JSON} AS doc FROM docs)) "
        "GROUP BY 1, 2",
    ),
    "schema_infer": f"""
SELECT 'OBJECT<' || string_agg(key || ': ' || type, ', ' ORDER BY key) || '>' AS schema
FROM (SELECT DISTINCT key, {JSON_TYPE.format("json_type(props::json, key)")} AS type
      FROM (SELECT props, unnest(json_keys(props::json)) AS key FROM events))""",
    "typeof_distinct": "SELECT DISTINCT CASE typeof(props) WHEN 'VARCHAR' THEN 'string' END AS type FROM events",
    "lookup_explode": """
SELECT event_id, key, props::json ->> key AS value
FROM (SELECT event_id, props, unnest(json_keys(props::json)) AS key FROM events)""",
    # rules and profiles
    "rule_required": with_(
        DOCS,
        "SELECT _id, _id IS NOT NULL AS has_id, name IS NOT NULL AS has_name, email IS NOT NULL AS has_email FROM docs",
    ),
    "rule_email_format": with_(DOCS, f"SELECT _id, {EMAIL_OR_TAG} AS email FROM docs"),
    "rule_optional_defaults": with_(
        DOCS,
        "SELECT _id, coalesce(phone, 'N/A') AS phone, coalesce(occupation, '') AS occupation_strict, "
        "coalesce(occupation, 'Unkown') AS occupation_sentinel FROM docs",
    ),
    "rule_gender": with_(
        DOCS,
        f"SELECT _id, {KNOWN_GENDER} AS is_known, {CANONICAL_GENDER} AS canonical, "
        f"{GENDER_AS_TYPED} AS as_typed, {GENDER_OR_TAG} AS tagged FROM docs",
    ),
    "rule_age": with_(AGED, "SELECT _id, age AS age_text, good_age AS age FROM aged"),
    "rule_address": with_(
        DOCS,
        f"SELECT _id, trim(address) AS address, coalesce(trim(address) IN {PROVINCES}, false) AS is_known FROM docs",
    ),
    "clean_strict": with_(STRICT, "SELECT * FROM strict"),
    "clean_sentinel": with_(SENTINEL, "SELECT * FROM sentinel"),
    "clean_tag": with_(TAGGED, f"SELECT {CLEAN} FROM tagged"),
    "clean_tag_json": with_(TAGGED, f"SELECT cast({TAG_JSON} AS varchar) AS cleaned_data FROM tagged"),
    "clean_rejects": with_(
        f"""{AGED},
broken AS (
  SELECT _id,
    [_id IS NULL, name IS NULL, email IS NULL, gender IS NOT NULL AND NOT ({KNOWN_GENDER}),
     age IS NOT NULL AND good_age IS NULL, address IS NOT NULL AND trim(address) NOT IN {PROVINCES}] AS rules
  FROM aged
),
named AS (
  SELECT _id, rules, ['_id', 'name', 'email', 'gender', 'age', 'address'] AS names FROM broken
)""",
        "SELECT _id, cast(list_sum(list_transform(range(1, 7), lambda i: "
        "CASE WHEN rules[i] THEN 1 << i ELSE 0 END)) AS integer) AS fail_bits, "
        "array_to_string(list_filter(names, lambda x, i: rules[i]), ',') AS reasons "
        "FROM named WHERE list_contains(rules, true)",
    ),
    "load_append": with_(
        USERS_RAW,
        "SELECT id AS _id, name || ' of load ' || CASE WHEN cast(id AS bigint) % 3 <> 0 THEN '1' ELSE '2' END AS name "
        "FROM users_raw WHERE cast(id AS bigint) % 3 <> 0 OR cast(id AS bigint) % 2 = 0",
    ),
    "valid_province_join": with_(
        USERS_RAW, f"SELECT id, address FROM users_raw WHERE trim(address) IN {PROVINCES}"
    ),
    # de-duplication and keys
    "dedupe_email": with_(USERS, "SELECT * FROM users"),
    "dedupe_email_sentinel": with_(SENTINEL, f"SELECT * FROM sentinel QUALIFY {SURVIVOR}"),
    "insert_ignore": with_(
        f"""{USERS_RAW},
batch AS (
  SELECT cast(l_orderkey AS varchar) AS id, l_returnflag AS name, l_linestatus AS phone FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_linestatus) = 1
)""",
        "SELECT id, name, phone FROM users_raw UNION ALL "
        "SELECT * FROM batch WHERE id NOT IN (SELECT id FROM users_raw)",
    ),
    "surrogate_keys": with_(
        DOCS,
        "SELECT cast(row_number() OVER (ORDER BY email) AS integer) AS email_id, email "
        "FROM (SELECT DISTINCT email FROM docs WHERE email IS NOT NULL)",
    ),
    "surrogate_keys_incremental": with_(
        f"""{USERS},
known AS (
  SELECT row_number() OVER (ORDER BY email) AS email_id, email FROM (SELECT DISTINCT email FROM users)
),
fresh AS (
  SELECT (SELECT max(email_id) FROM known) + row_number() OVER (ORDER BY email) AS email_id, email FROM
  (SELECT DISTINCT email FROM docs WHERE email IS NOT NULL AND email NOT IN (SELECT email FROM known))
)""",
        "SELECT cast(email_id AS integer) AS email_id, email FROM (SELECT * FROM known UNION ALL SELECT * FROM fresh)",
    ),
    # star and insight
    **{
        name: with_(STAR, f"SELECT * FROM {name}")
        for name in ("dim_user", "dim_address", "dim_occupation", "dim_age_group", "fct_user")
    },
    **{
        name: with_(INSIGHTS, f"SELECT * FROM {name}")
        for name in ("insight_age", "insight_region", "insight_occupation", "insight_gender")
    },
    "dim_address_wide": f"""
SELECT cast(row_number() OVER (ORDER BY p_name) AS integer) AS address_id, p_name AS province,
  {case_of('p_name', fv.PROVINCE_REGION, fv.OTHER)} AS region
FROM (SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL)""",
    "province_region_table": f"""
WITH addresses AS (
  SELECT DISTINCT p_name || CASE WHEN p_partkey % 3 = 0 THEN '?' ELSE '' END AS province FROM part
),
regions AS (SELECT p_name AS province, min(p_brand) AS region FROM part GROUP BY p_name)
SELECT cast(row_number() OVER (ORDER BY province) AS integer) AS address_id, province,
  coalesce(region, {quoted(fv.OTHER)}) AS region
FROM addresses LEFT JOIN regions USING (province) WHERE province IS NOT NULL""",
    "star_from_tag": with_(
        f"""{TAGGED},
tag_segments AS (
  SELECT 'age' AS segment_type, {AGE_GROUP.format('good_age')} AS description FROM tagged
  UNION ALL SELECT 'region', {case_of('address', fv.PROVINCE_REGION, fv.OTHER)} FROM tagged
  UNION ALL SELECT 'occupation_group', {case_of('occupation', fv.OCCUPATION_CATEGORY, fv.OTHER)} FROM tagged
  UNION ALL SELECT 'gender', gender FROM tagged
)""",
        "SELECT row_number() OVER (ORDER BY segment_type, description NULLS FIRST) AS id, segment_type, "
        "description, count(*) AS user_count FROM tag_segments GROUP BY segment_type, description",
    ),
    "segment_insight": with_(
        INSIGHTS,
        "SELECT row_number() OVER (ORDER BY segment_type, description NULLS FIRST) AS id, * FROM segments",
    ),
    "segment_insight_star": with_(
        INSIGHTS,
        "SELECT row_number() OVER (ORDER BY segment_type, description NULLS FIRST) AS id, * FROM segments",
    ),
    # tables
    "partition_scan": with_(DATED, f"SELECT {CLEAN}, dt FROM dated WHERE dt = DATE '2025-07-01'"),
    "partition_overwrite": with_(
        DATED,
        "SELECT _id, name, email, CASE WHEN dt = DATE '2025-07-02' THEN 'rewritten' ELSE phone END AS phone, "
        "gender, age, address, occupation, dt FROM dated",
    ),
    "star_roundtrip": with_(
        STAR,
        "SELECT * FROM fct_user LEFT JOIN dim_address USING (address_id) "
        "LEFT JOIN dim_occupation USING (occupation_id) LEFT JOIN dim_age_group USING (age_group_id) "
        "JOIN dim_user USING (user_id)",
    ),
    "merge_star": with_(
        STAR,
        "SELECT user_id, name, email, gender, province, region, "
        "occupation_name, category, description "
        "FROM fct_user LEFT JOIN dim_address USING (address_id) "
        "LEFT JOIN dim_occupation USING (occupation_id) LEFT JOIN dim_age_group USING (age_group_id) "
        "JOIN dim_user USING (user_id)",
    ),
    "merge_star_versions": with_(
        STAR,
        "SELECT user_id, name, email, gender, province, region, "
        "occupation_name, category, description "
        "FROM fct_user LEFT JOIN dim_address USING (address_id) "
        "LEFT JOIN dim_occupation USING (occupation_id) LEFT JOIN dim_age_group USING (age_group_id) "
        "JOIN dim_user USING (user_id)",
    ),
    "insight_delta": with_(
        INSIGHTS,
        "SELECT row_number() OVER (ORDER BY segment_type, description NULLS FIRST) AS id, * FROM segments",
    ),
    "batch_check": with_(
        f"""{STAR},
batch AS (
  SELECT cast(user_id AS bigint) AS id,
    CASE WHEN cast(user_id AS bigint) % 7 = 0 THEN repeat('n', 256) ELSE name END AS name,
    CASE WHEN cast(user_id AS bigint) % 5 = 0 THEN 'user' || (cast(user_id AS bigint) + 1) || '@example.com'
      ELSE email END AS email
  FROM dim_user WHERE cast(user_id AS bigint) % 2 = 0
),
merged AS (
  SELECT email FROM batch UNION ALL SELECT email FROM dim_user WHERE cast(user_id AS bigint) % 2 = 1
),
report AS (
  SELECT 'unique' AS "constraint", 'dim_user' AS "table", 'email' AS "column",
    (SELECT count(*) FROM (SELECT email FROM merged GROUP BY email HAVING count(*) > 1)) AS n_violations
  UNION ALL SELECT 'length', 'dim_user', 'name', (SELECT count(*) FROM batch WHERE length(name) > 255)
  UNION ALL SELECT 'foreign key', 'fct_user', 'user_id', (SELECT count(*) FROM batch WHERE id % 11 = 0)
)""",
        "SELECT * FROM report WHERE n_violations > 0",
    ),
    # upsert and integrity
    "upsert_dim": with_(
        f"""{STAR},
staging AS (
  SELECT cast(user_id AS varchar) AS user_id, 'seen in events: ' || count(*) AS name,
    'seen' || user_id || '@example.com' AS email
  FROM events GROUP BY user_id
)""",
        "SELECT * FROM staging UNION ALL SELECT * FROM dim_user WHERE user_id NOT IN (SELECT user_id FROM staging)",
    ),
    "upsert_fact": with_(
        f"""{STRICT},
{SENTINEL.removeprefix(AGED + ",")},
users AS (SELECT * FROM strict QUALIFY {SURVIVOR}),
lenient AS (SELECT * FROM sentinel QUALIFY {SURVIVOR}),
both_users AS (
  SELECT 1 AS rank, _id AS user_id, {AGE_GROUP.format('age')} AS description, gender FROM lenient
  UNION ALL SELECT 2, _id, {AGE_GROUP.format('age')}, gender FROM users
),
age_groups AS (
  SELECT cast(row_number() OVER (ORDER BY description) AS integer) AS age_group_id, description
  FROM (SELECT DISTINCT description FROM both_users)
)""",
        "SELECT user_id, age_group_id, gender FROM both_users JOIN age_groups USING (description) "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rank) = 1",
    ),
    "pk_violations": """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey
HAVING count(*) > 1 OR l_orderkey IS NULL""",
    "unique_violations": with_(
        DOCS,
        "SELECT email, count(*) AS n_rows FROM docs WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1",
    ),
    "fk_orphans": with_(
        USERS,
        "SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM users WHERE cast(_id AS bigint) = o_custkey) GROUP BY o_custkey",
    ),
    "length_violations": """
SELECT p_partkey, 'p_name' AS column_name, cast(length(p_name) AS integer) AS n_chars, 9 AS max_chars
FROM part WHERE length(p_name) > 9
UNION ALL
SELECT p_partkey, 'p_type', cast(length(p_type) AS integer), 7 FROM part WHERE length(p_type) > 7""",
}
