"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions import cast, encode, similarity, text
from kinlink.operators import best, blocking, matching, names, ordering, rules, similar, stats, survivorship
from kinlink.operators.city import standardize_city
from kinlink.plans.linkage import link
from kinlink.plans.phases import phase_inputs, run_phase, run_phases
from kinlink.plans.settings import PHASES, Settings
from kinlink.sources import lookups, tables
from kinlink.sources.metrics import log_metrics, read_metrics
from kinlink.storage import materialize, shared_dir
from suite import duck
from suite.parties import (
    ABBREVIATIONS,
    ADDRESSES,
    LEFT_PARTY,
    LEFT_RAW,
    NAMES,
    RIGHT_PARTY,
    RIGHT_RAW,
    keyed_parties,
    sql,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


_done: dict[tuple[str, str, str], object] = {}


def once(make: Callable) -> Callable:
    """Results that are stored tables anyway are made once per application and input."""

    def get(spark: SparkSession, sf: str):
        key = (spark.sparkContext.applicationId, sf, make.__name__)
        if key not in _done:
            _done[key] = make(spark, sf)
        return _done[key]

    return get


def forget() -> None:
    """Forget what earlier queries stored, so that the next one does all its work."""
    _done.clear()


@once
def parties(spark, sf):
    return keyed_parties(spark, sf)


@once
def phase1_matches(spark, sf):
    return run_phase(*parties(spark, sf), PHASES[0])


@once
def all_matches(spark, sf):
    return run_phases(*parties(spark, sf))


def check(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            SQL[name] = oracle
        return query

    return add


# --- casts, default values, keys ------------------------------------------------------------------------------

NUMBERS = """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN concat(' ', CAST(user_id AS STRING), ' ')
 WHEN 3 THEN concat(CAST(user_id AS STRING), '.0') WHEN 4 THEN event_type WHEN 5 THEN concat('-', CAST(user_id AS STRING))
 WHEN 6 THEN NULL ELSE props END AS raw FROM events
"""


@check(
    "cast_int",
    f"""SELECT event_id, CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+(\\.0)?')
     THEN CAST(TRY_CAST(trim(raw) AS DOUBLE) AS BIGINT) END AS number FROM ({NUMBERS}) t""",
)
def cast_int(spark, sf):
    raw = cast.blank_to_null(F.col("raw"))
    return sql(spark, sf, NUMBERS).select("event_id", cast.as_integer(raw).alias("number"))


@check("cast_str", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def cast_str(spark, sf):
    columns = ["o_orderkey", "o_custkey"]
    return sql(spark, sf, "SELECT * FROM orders").select([cast.as_text(F.col(c)).alias(c) for c in columns])


ZIPS = """SELECT page_id, CASE page_id % 3 WHEN 0 THEN concat(url, ' PA ', CAST(page_id * 7919 AS STRING), '-0001')
 WHEN 1 THEN url ELSE concat(CAST(10000 + page_id AS STRING), '1234') END AS raw FROM pages"""


@check("zip5", f"SELECT page_id, nullif(regexp_extract(raw, '([0-9]{{5}})', 1), '') AS zip FROM ({ZIPS}) t")
def zip5(spark, sf):
    return sql(spark, sf, ZIPS).select("page_id", cast.zip5(F.col("raw")).alias("zip"))


TAX_IDS = """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN '-'
 WHEN 3 THEN concat('12-', lpad(CAST(c_custkey AS STRING), 7, '0'))
 WHEN 4 THEN concat(' 00 ', lpad(CAST(c_custkey AS STRING), 5, '0'), ' ') ELSE CAST(c_custkey AS STRING) END AS raw FROM customer"""


@check(
    "fein_normalize",
    f"""SELECT c_custkey, CAST(coalesce(nullif(regexp_replace(raw, '[\\s-]+', '', 'g'), ''), '000000000') AS BIGINT)
     AS fein FROM ({TAX_IDS}) t""",
)
def fein_normalize(spark, sf):
    return sql(spark, sf, TAX_IDS).select("c_custkey", cast.tax_id(F.col("raw")).alias("fein"))


@check(
    "fill_defaults",
    f"""SELECT record_id, coalesce(nullif(city, ''), 'MISSING') AS city, coalesce(nullif(zip, ''), '99999') AS zip
     FROM ({LEFT_PARTY}) t""",
)
def fill_defaults(spark, sf):
    return sql(spark, sf, LEFT_PARTY).select(
        "record_id",
        cast.fill_default(F.col("city"), cast.MISSING_TEXT).alias("city"),
        cast.fill_default(F.col("zip"), cast.MISSING_ZIP).alias("zip"),
    )


STREETS_WITH_FILLERS = f"""SELECT record_id, CASE record_id % 9 WHEN 0 THEN 'PA' WHEN 1 THEN 'STATE OF DE' WHEN 2 THEN 'pa'
 WHEN 3 THEN 'NO SPECIFIC LOCATION' WHEN 4 THEN 'PA ' ELSE street END AS raw FROM ({LEFT_PARTY}) l"""


@check(
    "placeholder_replace",
    f"""SELECT record_id, CASE WHEN raw IN ('STATE OF PA', 'STATE OF DE', 'PA', 'DE', 'NO SPECIFIC LOCATION')
     THEN 'MISSING' ELSE raw END AS street FROM ({STREETS_WITH_FILLERS}) t""",
)
def placeholder_replace(spark, sf):
    return sql(spark, sf, STREETS_WITH_FILLERS).select("record_id", cast.replace_placeholder(F.col("raw")).alias("street"))


@check(
    "composite_key",
    f"""SELECT record_id, concat(CAST(fein AS VARCHAR), '_', coalesce({duck.common("street")}, '')) AS fein_address
     FROM ({LEFT_PARTY}) t""",
)
def composite_key(spark, sf):
    street = text.standardize_street(F.col("street"), ABBREVIATIONS)
    return sql(spark, sf, LEFT_PARTY).select("record_id", cast.composite_key(F.col("fein"), street).alias("fein_address"))


@check(
    "match_keys",
    f"""SELECT 'L' AS side, record_id, zip, upper(trim(city)) AS city, upper(trim({duck.common("street")})) AS street,
     upper(trim({duck.business_name("name")})) AS name, NULL AS parent FROM ({LEFT_PARTY}) t
     UNION ALL SELECT 'R', record_id, zip, upper(trim(city)), upper(trim({duck.common("street")})),
     upper(trim({duck.business_name("name")})), upper(trim({duck.business_name("parent")})) FROM ({RIGHT_PARTY}) t""",
)
def match_keys(spark, sf):
    left, right = parties(spark, sf)
    named_left = {old: F.col(new) for new, old in blocking.LEFT_KEYS.items()} | {"Zipcode": F.col("Zip_UPDATED")}
    named_right = {old: F.col(new) for new, old in blocking.RIGHT_KEYS.items()} | {"physical_zip": F.col("Zip_UPDATED")}
    a = left.withColumns(named_left).select("record_id", *named_left)
    b = right.withColumns(named_right).select("record_id", *named_right)
    a, b = blocking.add_match_keys(a, b)
    a = a.withColumn("GlobalName_UPDATED", F.lit(None).cast("string"))

    def out(df, side):
        return df.select(
            F.lit(side).alias("side"),
            "record_id",
            F.col("Zip_UPDATED").alias("zip"),
            F.col("City_UPDATED").alias("city"),
            F.col("Street_UPDATED").alias("street"),
            F.col("BusinessName_UPDATED").alias("name"),
            F.col("GlobalName_UPDATED").alias("parent"),
        )

    return out(a, "L").unionByName(out(b, "R"))


@check(
    "record_ids",
    """SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS record_id, 'L' AS side FROM customer
     UNION ALL SELECT s_suppkey, row_number() OVER (ORDER BY s_name), 'R' FROM supplier""",
)
def record_ids(spark, sf):
    left = sql(spark, sf, "SELECT c_custkey, c_acctbal FROM customer")
    right = sql(spark, sf, "SELECT s_suppkey AS c_custkey, s_name FROM supplier")
    a, b = ordering.add_record_ids(left, right, "record_id", ["c_acctbal", "c_custkey"], ["s_name"])
    a, b = a.withColumn("side", F.lit("L")), b.withColumn("side", F.lit("R"))
    return a.select("c_custkey", "record_id", "side").unionByName(b.select("c_custkey", "record_id", "side"))


# --- standardisers --------------------------------------------------------------------------------------------


def _address_check(name: str, oracle: str, expression: Callable) -> None:
    @check(name, f"SELECT side, record_id, {oracle} AS result FROM ({ADDRESSES}) t")
    def query(spark, sf):
        return sql(spark, sf, ADDRESSES).select("side", "record_id", expression(F.col("address")).alias("result"))


def _name_check(name: str, oracle: str, expression: Callable) -> None:
    @check(name, f"SELECT id, {oracle} AS result FROM ({NAMES}) t")
    def query(spark, sf):
        return sql(spark, sf, NAMES).select("id", expression(F.col("name")).alias("result"))


_address_check("std_common", duck.common("address"), lambda c: text.standardize_text(c, ABBREVIATIONS))
_address_check("std_street", duck.common("address"), lambda c: text.standardize_street(c, ABBREVIATIONS))
_address_check(
    "std_street_no_numbers", duck.no_numbers("address"), lambda c: text.standardize_street_no_numbers(c, ABBREVIATIONS)
)
_name_check("number_words", duck.number_words("upper(name)"), lambda c: text.replace_number_words(F.upper(c)))
_name_check("separate_suffix", duck.suffix_split("upper(name)"), lambda c: text.separate_suffix(F.upper(c)))
_name_check("remove_common_words", duck.without_common("upper(name)"), lambda c: text.remove_common_words(F.upper(c)))
_name_check("std_business_name", duck.business_name("name"), lambda c: text.standardize_business_name(c, ABBREVIATIONS))
_name_check(
    "std_business_name_no_spaces",
    f"replace({duck.business_name('name')}, ' ', '')",
    lambda c: text.standardize_business_name(c, ABBREVIATIONS, remove_spaces=True),
)
_name_check("preprocess", "coalesce(trim(name), '')", text.preprocess)

_WHOLE = "concat_ws(', ', street, city, nullif(concat_ws(' ', 'PA', zip), ''))"


@check("std_full_address", f"SELECT record_id, {duck.full_address(_WHOLE)} AS result FROM ({LEFT_PARTY}) t")
def std_full_address(spark, sf):
    whole = text.full_address(F.col("street"), F.col("city"), F.lit("PA"), F.col("zip"))
    party = sql(spark, sf, LEFT_PARTY)
    return party.select("record_id", text.standardize_full_address(whole, ABBREVIATIONS).alias("result"))


SHEET = """SELECT p_partkey AS line, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE split_part(p_name, ' ', 1) END AS a,
 CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS b, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS c
 FROM part"""


@check(
    "abbrev_map",
    f"""SELECT word, arg_max(value, place) AS abbreviation, min(place) AS position FROM (
     SELECT line * 2 AS place, a AS word, c AS value FROM ({SHEET}) t
     UNION ALL SELECT line * 2 + 1, b, c FROM ({SHEET}) t) WHERE word IS NOT NULL AND value IS NOT NULL GROUP BY word""",
)
def abbrev_map(spark, sf):
    sheet = sql(spark, sf, SHEET).toDF("line", *lookups.SHEET_COLUMNS)
    return lookups.abbreviation_entries(sheet)


@check("word_list", "SELECT DISTINCT upper(trim(split_part(p_name, ' ', 2))) AS word FROM part")
def word_list(spark, sf):
    return lookups.word_list(sql(spark, sf, "SELECT split_part(p_name, ' ', 2) AS value FROM part"))


CITIES = """SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN n_name WHEN 1 THEN replace(lower(n_name), 'nation', 'naton')
 WHEN 2 THEN concat(' ', n_name, ' ') WHEN 3 THEN 'MISSING' WHEN 4 THEN NULL WHEN 5 THEN concat('nett ', c_mktsegment)
 WHEN 6 THEN concat('x ', c_mktsegment) ELSE concat(n_name, '0') END AS city
 FROM customer JOIN nation ON c_nationkey = n_nationkey"""


@check(
    "std_city",
    f"""WITH c AS (SELECT DISTINCT upper(trim(city)) AS city FROM ({CITIES}) t WHERE upper(trim(city)) <> 'MISSING'),
     r AS (SELECT DISTINCT n_name AS ref FROM nation),
     s AS (SELECT city, ref, {duck.indel("cs", "rs")} AS score, {duck.soundex("city")} = {duck.soundex("ref")} AS alike
       FROM (SELECT city, ref, {duck.sorted_tokens("city")} AS cs, {duck.sorted_tokens("ref")} AS rs FROM c, r)),
     fuzzy AS (SELECT city, arg_min(ref, (-score, ref)) AS ref FROM s WHERE score >= 85 GROUP BY city),
     sound AS (SELECT city, arg_min(ref, (-score, ref)) AS ref FROM s WHERE alike GROUP BY city)
     SELECT t.c_custkey, coalesce(e.ref, fuzzy.ref, sound.ref) AS std_city FROM ({CITIES}) t
     LEFT JOIN r e ON e.ref = upper(trim(t.city)) LEFT JOIN fuzzy ON fuzzy.city = upper(trim(t.city))
     LEFT JOIN sound ON sound.city = upper(trim(t.city))""",
)
def std_city(spark, sf):
    cities = sql(spark, sf, CITIES)
    return standardize_city(cities, "city", spark.table("nation").select("n_name"), "std_city").select("c_custkey", "std_city")


# --- similarity -----------------------------------------------------------------------------------------------

NAME_PAIRS = """SELECT l.p_partkey AS a_id, r.p_partkey AS b_id, concat(l.p_name, ' ', lower(l.p_type)) AS a,
 CASE WHEN r.p_partkey % 50 = 0 THEN NULL ELSE concat(lower(r.p_type), ' ', r.p_name) END AS b
 FROM part l JOIN part r ON r.p_partkey = l.p_partkey + 1"""


def _pair_check(name: str, oracle: str, expression: Callable) -> None:
    @check(name, f"SELECT a_id, b_id, round({oracle}, 4) AS score FROM ({NAME_PAIRS}) t")
    def query(spark, sf):
        score = expression(F.col("a"), F.col("b"))
        return sql(spark, sf, NAME_PAIRS).select("a_id", "b_id", F.round(score, 4).alias("score"))


_pair_check("indel_ratio", duck.indel("a", "b"), similarity.indel_ratio)
_pair_check("indel_ratio_native", duck.indel("a", "b"), similarity.indel_ratio_native)
_pair_check(
    "token_sort_ratio", duck.indel(duck.sorted_tokens("a"), duck.sorted_tokens("b")), similarity.token_sort_ratio
)
_pair_check("token_set_ratio", duck.token_set("a", "coalesce(b, '')"), similarity.token_set_ratio)


@check(
    "soundex_blocks",
    f"""SELECT code, count(*) AS n_names, min(value) AS first_name FROM (SELECT DISTINCT name AS value,
     {duck.soundex("name")} AS code FROM ({NAMES}) t WHERE name IS NOT NULL) GROUP BY code""",
)
def soundex_blocks(spark, sf):
    groups = names.sound_groups(sql(spark, sf, NAMES).select(F.col("name").alias("value")).where("name IS NOT NULL"))
    return groups.groupBy("code").agg(F.count("*").alias("n_names"), F.min("value").alias("first_name"))


@check(
    "similar_names",
    f"""WITH v AS (SELECT DISTINCT p_brand AS brand, upper(p_name) AS value FROM part),
     w AS (SELECT DISTINCT p_brand AS brand, upper(replace(p_name, 'e', 'a')) AS value FROM part)
     SELECT brand, left_value, right_value, round(score, 4) AS score FROM (SELECT v.brand, v.value AS left_value,
     w.value AS right_value, {duck.indel("v.value", "w.value")} AS score FROM v JOIN w USING (brand)) WHERE score >= 85""",
)
def similar_names(spark, sf):
    left = sql(spark, sf, "SELECT p_brand AS brand, upper(p_name) AS value FROM part")
    right = sql(spark, sf, "SELECT p_brand AS brand, upper(replace(p_name, 'e', 'a')) AS value FROM part")
    pairs = similar.similar_values(left, right, 85.0, ["brand"])
    return pairs.withColumn("score", F.round("score", 4))


_VECTORS = "SELECT vec_id, embedding, label FROM embeddings"


@check(
    "cosine_pairs",
    f"""SELECT * FROM (SELECT l.label, l.vec_id AS left_id, r.vec_id AS right_id,
     round(list_cosine_similarity(l.embedding::DOUBLE[], r.embedding::DOUBLE[]), 4) AS score
     FROM ({_VECTORS}) l JOIN ({_VECTORS}) r ON l.label = r.label AND l.vec_id % 2 = 0 AND r.vec_id % 2 = 1)
     WHERE score >= 0.3""",
)
def cosine_pairs(spark, sf):
    every = sql(spark, sf, _VECTORS).select(
        F.col("label").cast("string").alias("block"), "vec_id", F.col("embedding").alias("vs"), F.col("embedding").alias("vn")
    )
    left = every.where("vec_id % 2 = 0").withColumnRenamed("vec_id", "left_class")
    right = every.where("vec_id % 2 = 1").withColumnRenamed("vec_id", "right_class").withColumns(
        {"parent": F.lit(None).cast("string"), "vp": F.lit(None).cast("array<float>")}
    )
    close = matching.vector_pairs(left, right, [rules.Rule("", 0.29, 0.29, 2.0)])
    score = F.round("street_score", 4)
    return close.where(score >= 0.3).select(
        F.col("block").cast("int").alias("label"),
        F.col("left_class").alias("left_id"),
        F.col("right_class").alias("right_id"),
        score.alias("score"),
    )


@check(
    "cosine",
    f"""SELECT l.vec_id, round(list_cosine_similarity(l.embedding::DOUBLE[], r.embedding::DOUBLE[]), 4) AS score
     FROM ({_VECTORS}) l JOIN ({_VECTORS}) r ON r.vec_id = l.vec_id + 1""",
)
def cosine(spark, sf):
    left = sql(spark, sf, _VECTORS)
    right = left.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    score = similarity.cosine(F.col("embedding"), F.col("other"))
    return left.join(right, "vec_id").select("vec_id", F.round(score, 4).alias("score"))


@check(
    "hash_embed",
    """WITH texts AS (SELECT DISTINCT md5(t) AS text_key, '  ' || t || ' ' AS p FROM (
       SELECT text AS t FROM documents UNION SELECT url FROM pages) WHERE t IS NOT NULL),
     grams AS (SELECT text_key, ('0x' || substr(md5(p[i:i + 2]), 1, 2))::INT AS slot
       FROM (SELECT text_key, p, unnest(range(1, length(p) - 1)) AS i FROM texts)),
     counts AS (SELECT text_key, slot, count(*) AS n FROM grams GROUP BY text_key, slot)
     SELECT text_key, count(*) AS filled, round((max(n) / sqrt(sum(n * n)))::FLOAT::DOUBLE, 4) AS top,
     arg_min(slot, (-n, slot)) AS top_slot FROM counts GROUP BY text_key""",
)
def hash_embed(spark, sf):
    texts = sql(spark, sf, "SELECT text FROM documents UNION SELECT url FROM pages")
    v = F.col("vector")
    return encode.encode_distinct(texts, "text").select(
        F.md5("text").alias("text_key"),
        F.size(F.filter(v, lambda x: x > 0)).cast("bigint").alias("filled"),
        F.round(F.array_max(v).cast("double"), 4).alias("top"),
        (F.array_position(v, F.array_max(v)) - 1).cast("int").alias("top_slot"),
    )


# --- blocks ---------------------------------------------------------------------------------------------------


def _link_checks() -> None:
    for name, key, value, column in (
        ("zip_to_cities", "zip", "city", "cities"),
        ("city_to_zips", "city", "zip", "zips"),
    ):
        both = (
            f"SELECT {key}, {value} FROM ({LEFT_PARTY}) a WHERE {key} IS NOT NULL AND {value} IS NOT NULL"
            f" UNION SELECT {key}, {value} FROM ({RIGHT_PARTY}) b WHERE {key} IS NOT NULL AND {value} IS NOT NULL"
        )
        one = f"SELECT {key}, {value} FROM ({LEFT_PARTY}) a WHERE {key} IS NOT NULL AND {value} IS NOT NULL"

        def mapped(source: str, key=key, value=value, column=column) -> str:
            return f"SELECT {key}, array_to_string(list_sort(list(DISTINCT {value})), '|') AS {column} FROM ({source}) t GROUP BY {key}"

        def flat(mapping: DataFrame, key=key, column=column) -> DataFrame:
            return mapping.select(key, F.array_join(column, "|").alias(column))

        make = blocking.zip_to_cities if key == "zip" else blocking.city_to_zips

        @check(name, mapped(one))
        def query(spark, sf, key=key, value=value, make=make, flat=flat):
            return flat(make(sql(spark, sf, LEFT_PARTY), key, value))

        @check(f"merge_{name}", mapped(both))
        def merged(spark, sf, key=key, value=value, column=column, flat=flat):
            a = blocking.value_links(sql(spark, sf, LEFT_PARTY), key, value)
            b = blocking.value_links(sql(spark, sf, RIGHT_PARTY), key, value)
            return flat(blocking.as_mapping(blocking.merge_links(a, b), column))


_link_checks()

_COUNTS = f"""a AS (SELECT zip, count(*) AS n FROM ({LEFT_PARTY}) t WHERE zip IS NOT NULL GROUP BY zip),
 b AS (SELECT zip, count(*) AS n FROM ({RIGHT_PARTY}) t WHERE zip IS NOT NULL GROUP BY zip),
 counts AS (SELECT zip, coalesce(a.n, 0) AS count_left, coalesce(b.n, 0) AS count_right,
  coalesce(a.n, 0) * coalesce(b.n, 0) AS total_comparisons FROM a FULL JOIN b USING (zip))"""


def _counts(spark, sf, keep_zero):
    return blocking.block_counts(sql(spark, sf, LEFT_PARTY), sql(spark, sf, RIGHT_PARTY), "zip", keep_zero)


@check("block_counts", f"WITH {_COUNTS} SELECT * FROM counts")
def block_counts(spark, sf):
    return _counts(spark, sf, True)


@check("budget_report", f"WITH {_COUNTS} SELECT * FROM counts WHERE total_comparisons > 0 ORDER BY total_comparisons, zip")
def budget_report(spark, sf):
    return blocking.by_work(_counts(spark, sf, True))


_ORDER_COUNTS = """a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY o_custkey),
 b AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY l_suppkey),
 counts AS (SELECT k, coalesce(a.n, 0) * coalesce(b.n, 0) AS w FROM a FULL JOIN b USING (k))"""


def _batch_sql(counts: str, key: str, work: str, parts: int) -> str:
    return f"""WITH RECURSIVE {counts},
 placed AS MATERIALIZED (SELECT {key}, {work} AS w, row_number() OVER (ORDER BY {work}, {key}) AS i,
  (SELECT sum({work}) // {parts} FROM counts) AS budget FROM counts),
 walk(i, batch, done) AS (SELECT 0::BIGINT, 1::BIGINT, 0::HUGEINT UNION ALL
  SELECT p.i, CASE WHEN w.done >= p.budget AND w.i > 0 THEN w.batch + 1 ELSE w.batch END,
   CASE WHEN w.done >= p.budget AND w.i > 0 THEN p.w::HUGEINT ELSE w.done + p.w END
  FROM walk w JOIN placed p ON p.i = w.i + 1)
 SELECT p.{key}, p.w AS total_comparisons, w.batch FROM placed p JOIN walk w USING (i)"""


@check("batches", _batch_sql(_COUNTS, "zip", "total_comparisons", 5))
def batches(spark, sf):
    return blocking.batches(_counts(spark, sf, True), 5)


@check("batches_orders", _batch_sql(_ORDER_COUNTS, "k", "w", 30))
def batches_orders(spark, sf):
    left = sql(spark, sf, "SELECT o_custkey AS k FROM orders")
    counts = blocking.block_counts(left, sql(spark, sf, "SELECT l_suppkey AS k FROM lineitem"), "k", True)
    return blocking.batches(counts, 30)


_KNOWN = f"SELECT record_id, zip, city FROM ({LEFT_PARTY}) t WHERE zip IS NOT NULL AND city IS NOT NULL"


@check("semi_known", _KNOWN)
def semi_known(spark, sf):
    left = sql(spark, sf, LEFT_PARTY).select("record_id", "zip", "city")
    links = blocking.value_links(left, "zip", "city")
    return blocking.in_mapping(left, blocking.merge_links(links, blocking.value_links(sql(spark, sf, RIGHT_PARTY), "zip", "city")))


@check("known_block", _KNOWN)
def known_block(spark, sf):
    return blocking.with_known_block(sql(spark, sf, LEFT_PARTY).select("record_id", "zip", "city"), "zip", "city")


# --- survivors ------------------------------------------------------------------------------------------------

_HIERARCHY = f"""kept AS (SELECT record_id, fein, address_type, street FROM (SELECT *,
  max(CASE WHEN address_type = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY fein) AS has2,
  row_number() OVER (PARTITION BY fein ORDER BY address_type NULLS LAST, record_id) AS rn FROM ({LEFT_PARTY}) t)
  WHERE address_type = 2 OR (has2 = 0 AND rn = 1 AND address_type IS NOT NULL))"""


def _coded(spark, sf):
    party = sql(spark, sf, LEFT_PARTY).select("record_id", "fein", "address_type", "street")
    return survivorship.keep_best_codes(party, "fein", "address_type")


@check("hierarchy", f"WITH {_HIERARCHY} SELECT * FROM kept")
def hierarchy(spark, sf):
    return _coded(spark, sf)


def _lenient_check(name: str, kept: str, **options) -> None:
    """Tax ids that cannot be read are null: one group with the missing ones, or passed through."""
    raw = f"SELECT *, CASE WHEN record_id % 13 = 0 THEN NULL WHEN record_id % 17 = 0 THEN 0 ELSE fein END AS id FROM ({LEFT_PARTY}) p"

    @check(
        name,
        f"""WITH t AS (SELECT record_id, id, address_type, coalesce(id, 0) AS g FROM ({raw}) r), kept AS (SELECT *,
         max(CASE WHEN address_type = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY g) AS has2,
         row_number() OVER (PARTITION BY g ORDER BY address_type NULLS LAST, record_id) AS rn FROM t)
         SELECT record_id, id, address_type FROM kept WHERE {kept}""",
    )
    def query(spark, sf):
        party = sql(spark, sf, raw).select("record_id", "id", "address_type")
        return survivorship.keep_best_codes(party, "id", "address_type", **options)


_BEST = "address_type = 2 OR (has2 = 0 AND rn = 1"
_lenient_check("hierarchy_lenient", f"{_BEST} AND address_type IS NOT NULL)")
_lenient_check("hierarchy_pass", f"g = 0 OR {_BEST} AND address_type IS NOT NULL)", missing_ids="pass")
_lenient_check("hierarchy_uncoded", f"{_BEST})", keep_uncoded=True)


@check(
    "dedupe_key",
    f"""WITH {_HIERARCHY} SELECT record_id, fein, address_type, street FROM kept
     QUALIFY row_number() OVER (PARTITION BY fein, street ORDER BY record_id) = 1""",
)
def dedupe_key(spark, sf):
    return survivorship.keep_first(_coded(spark, sf), ["fein", "street"])


@check(
    "dedupe_record",
    """SELECT user_id, event_id, event_type FROM events
     QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
)
def dedupe_record(spark, sf):
    return survivorship.keep_first(sql(spark, sf, "SELECT user_id, event_id, event_type FROM events"), ["user_id"], "event_id")


# --- matching -------------------------------------------------------------------------------------------------

_CLASSES = f"""{duck.parties()},
 lc AS (SELECT zip, city, street, name, min(record_id) AS record_id FROM l WHERE {{key}} IS NOT NULL AND {{other}} IS NOT NULL
   GROUP BY ALL),
 rc AS (SELECT zip, city, street, name, parent, min(record_id) AS record_id FROM r WHERE {{key}} IS NOT NULL
   AND {{other}} IS NOT NULL GROUP BY ALL)"""


def _inputs(spark, sf, phase):
    left, right = parties(spark, sf)
    return phase_inputs(left, right, phase, Settings(), "record_id", "record_id")


def phase_sides(spark, sf):
    """The narrow tables of phase 1."""
    return _inputs(spark, sf, PHASES[0])


def _candidate_check(name: str, phase, key: str, other: str) -> None:
    classes = _CLASSES.format(key=key, other=other)

    @check(
        name,
        f"""WITH {classes}, {duck.scored("z", "lc", "rc", key, other)}
         SELECT block, left_id, right_id, round(ss, 4) AS street_score, round(ns, 4) AS name_score FROM z
         WHERE (ss >= 95 AND (ns >= 80 OR ps >= 80)) OR (ss >= 80 AND (ns >= 95 OR ps >= 90))""",
    )
    def query(spark, sf):
        left, right = _inputs(spark, sf, phase)
        pairs = matching.fuzzy_candidates(matching.left_classes(left), matching.right_classes(right), list(phase.rules))
        ss, ns, ps = (F.col(f"{c}_score") for c in ("street", "name", "parent"))
        passes = ((ss >= 95) & ((ns >= 80) | (ps >= 80))) | ((ss >= 80) & ((ns >= 95) | (ps >= 90)))
        return pairs.where(passes).select(
            "block",
            F.col("left_class").alias("left_id"),
            F.col("right_class").alias("right_id"),
            F.round(ss, 4).alias("street_score"),
            F.round(ns, 4).alias("name_score"),
        )


_candidate_check("candidates_zip", PHASES[0], "zip", "city")
_candidate_check("candidates_city", PHASES[1], "city", "zip")

_STRING = {r.method: r for r in (rules.M1, rules.M2)}
_VECTOR = {r.method: r for r in (rules.M3, rules.M4, rules.M5)}


def _rule(tag: str, rule, source: str, without: list[str]) -> str:
    pairs = duck.passing(f"p{tag}", source, rule.street, rule.name, rule.parent, without)
    return f"{pairs}, {duck.choose(tag, f'p{tag}')}"


_TEXT_VECTORS = duck.vectors(
    "SELECT street AS t FROM l UNION SELECT name FROM l UNION SELECT street FROM r UNION SELECT name FROM r UNION SELECT parent FROM r"
)
_Z1 = duck.scored("z1", "l", "r", "zip", "city")
_PHASE1 = f"{duck.parties()}, {_Z1}, {_rule('m1', rules.M1, 'z1', [])}, {_rule('m2', rules.M2, 'z1', ['m1'])}"
_PHASE2 = f"""{_PHASE1}, {duck.rest("l2", "l", "left", ["m1", "m2"])}, {duck.rest("r2", "r", "right", ["m1", "m2"])},
 {duck.scored("z2", "l2", "r2", "city", "zip")}, {_rule("n1", rules.M1, "z2", [])}, {_rule("n2", rules.M2, "z2", ["n1"])}"""
_PHASE3 = f"""{_PHASE2}, {duck.rest("l3", "l2", "left", ["n1", "n2"])}, {duck.rest("r3", "r2", "right", ["n1", "n2"])},
 {_TEXT_VECTORS}, {duck.vector_scored("z3", "l3", "r3", "zip", "city")}, {_rule("m3", rules.M3, "z3", [])},
 {_rule("m4", rules.M4, "z3", ["m3"])}, {_rule("m5", rules.M5, "z3", ["m3", "m4"])}"""
_MATCH_COLUMNS = (
    "block, left_id, right_id, round(street_score, 4) AS street_score, round(name_score, 4) AS name_score, used_global"
)


def _matched(*tags: tuple[str, str, int]) -> str:
    return " UNION ALL ".join(f"SELECT *, '{method}' AS method, {phase} AS phase FROM {tag}" for tag, method, phase in tags)


_M1, _M2 = ("m1", "Method 1", 1), ("m2", "Method 2", 1)
_N1, _N2 = ("n1", "Method 1", 2), ("n2", "Method 2", 2)
_M345 = (("m3", "Method 3", 3), ("m4", "Method 4", 3), ("m5", "Method 5", 3))


def _rounded(matches: DataFrame) -> DataFrame:
    return matches.withColumns({c: F.round(c, 4) for c in ("street_score", "name_score")})


def _one_rule_checks() -> None:
    for name, rule in (("fuzzy_m1", rules.M1), ("fuzzy_m2", rules.M2), ("fuzzy_default", rules.STRING_DEFAULT)):

        @check(
            name,
            f"WITH RECURSIVE {duck.parties()}, {_Z1}, {_rule('m', rule, 'z1', [])} SELECT {_MATCH_COLUMNS} FROM m",
        )
        def query(spark, sf, rule=rule):
            return _rounded(matching.fuzzy_match(*_inputs(spark, sf, PHASES[0]), [rule])).drop("method")

    vectors = f"{duck.parties()}, {_TEXT_VECTORS}, {duck.vector_scored('z', 'l', 'r', 'zip', 'city')}"
    for name, rule in (
        ("embed_m3", rules.M3),
        ("embed_m4", rules.M4),
        ("embed_m5", rules.M5),
        ("embed_default", rules.VECTOR_DEFAULT),
    ):

        @check(name, f"WITH RECURSIVE {vectors}, {_rule('m', rule, 'z', [])} SELECT {_MATCH_COLUMNS} FROM m")
        def embedded(spark, sf, rule=rule):
            return _rounded(matching.vector_match(*_inputs(spark, sf, PHASES[2]), [rule])).drop("method")


_one_rule_checks()


@check(
    "embedding_table_match",
    f"""WITH RECURSIVE z AS MATERIALIZED (SELECT CAST(l.label AS VARCHAR) AS block, l.vec_id AS left_id, r.vec_id AS right_id,
     NULL AS parent, list_cosine_similarity(l.embedding::DOUBLE[], r.embedding::DOUBLE[]) AS ss,
     list_cosine_similarity(l.embedding::DOUBLE[], r.embedding::DOUBLE[]) AS ns, -1 AS ps
     FROM ({_VECTORS}) l JOIN ({_VECTORS}) r ON l.label = r.label AND l.vec_id % 2 = 0 AND r.vec_id % 2 = 1),
     {_rule("m", rules.Rule("", 0.25, 0.25, 1.5), "z", [])} SELECT {_MATCH_COLUMNS} FROM m""",
)
def embedding_table_match(spark, sf):
    from kinlink.operators.assign import assign

    every = sql(spark, sf, _VECTORS).select(
        F.col("label").cast("string").alias("block"), "vec_id", F.col("embedding").alias("vs"), F.col("embedding").alias("vn")
    )
    left = every.where("vec_id % 2 = 0").withColumnRenamed("vec_id", "left_class")
    right = every.where("vec_id % 2 = 1").withColumnRenamed("vec_id", "right_class").withColumns(
        {"parent": F.lit(None).cast("string"), "vp": F.lit(None).cast("array<float>")}
    )
    rule = rules.Rule("", 0.25, 0.25, 1.5)
    pairs = rules.passing(matching.vector_pairs(left, right, [rule]), rule)
    own = left.select("left_class", F.col("left_class").alias("left_id"))
    other = right.select("right_class", F.col("right_class").alias("right_id"))
    return _rounded(assign(pairs, own, other))


@check("phase1", f"WITH RECURSIVE {_PHASE1} SELECT {_MATCH_COLUMNS}, method FROM ({_matched(_M1, _M2)})")
def phase1(spark, sf):
    return _rounded(phase1_matches(spark, sf)).drop("phase")


@check(
    "phase2",
    f"""WITH RECURSIVE {duck.parties()}, {duck.scored("z2", "l", "r", "city", "zip")}, {_rule("n1", rules.M1, "z2", [])},
     {_rule("n2", rules.M2, "z2", ["n1"])} SELECT {_MATCH_COLUMNS}, method FROM ({_matched(_N1, _N2)})""",
)
def phase2(spark, sf):
    return _rounded(run_phase(*parties(spark, sf), PHASES[1])).drop("phase")


@check(
    "phase3",
    f"""WITH RECURSIVE {duck.parties()}, {_TEXT_VECTORS}, {duck.vector_scored("z3", "l", "r", "zip", "city")},
     {_rule("m3", rules.M3, "z3", [])}, {_rule("m4", rules.M4, "z3", ["m3"])}, {_rule("m5", rules.M5, "z3", ["m3", "m4"])}
     SELECT {_MATCH_COLUMNS}, method FROM ({_matched(*_M345)})""",
)
def phase3(spark, sf):
    return _rounded(run_phase(*parties(spark, sf), PHASES[2])).drop("phase")


def _filled(side: str, *more: str) -> str:
    """A party with texts left out, and the filler in their place."""
    texts = (f"coalesce(CASE WHEN record_id % {n} > 0 THEN {c} END, 'Missing') AS {c}" for c, n in (("street", 13), ("name", 17)))
    return f"{side}f AS MATERIALIZED (SELECT record_id, zip, city, {', '.join([*texts, *more])} FROM {side})"


@check(
    "phase3_filled",
    f"""WITH RECURSIVE {duck.parties()}, {_filled("l")}, {_filled("r", "parent")},
     {duck.vectors(" UNION ".join(f"SELECT {c} AS t FROM {t}" for c, t in (("street", "lf"), ("name", "lf"), ("street", "rf"), ("name", "rf"), ("parent", "rf"))))},
     {duck.vector_scored("z3", "lf", "rf", "zip", "city")},
     {_rule("m3", rules.M3, "z3", [])}, {_rule("m4", rules.M4, "z3", ["m3"])}, {_rule("m5", rules.M5, "z3", ["m3", "m4"])}
     SELECT {_MATCH_COLUMNS}, method FROM ({_matched(*_M345)})""",
)
def phase3_filled(spark, sf):
    """The vector phase with a filler for missing texts, so that rows without a street or name take part."""

    def without(df):
        some = (("Street_UPDATED", 13), ("BusinessName_UPDATED", 17))
        return df.withColumns({c: F.when(F.col("record_id") % n > 0, F.col(c)) for c, n in some})

    left, right = map(without, parties(spark, sf))
    return _rounded(run_phase(left, right, PHASES[2], Settings(fill_missing=True))).drop("phase")


@check("phases", f"WITH RECURSIVE {_PHASE3} SELECT {_MATCH_COLUMNS}, method, phase FROM ({_matched(_M1, _M2, _N1, _N2, *_M345)})")
def phases(spark, sf):
    return _rounded(all_matches(spark, sf))


_BOTH1 = "(SELECT left_id, right_id FROM m1 UNION ALL SELECT left_id, right_id FROM m2)"


@check(
    "unmatched_left",
    f"""WITH RECURSIVE {_PHASE1} SELECT record_id, zip, city, street, name, false AS matched FROM l
     WHERE record_id NOT IN (SELECT left_id FROM {_BOTH1})""",
)
def unmatched_left(spark, sf):
    left, right = parties(spark, sf)
    gone = matching.unmatched(left, phase1_matches(spark, sf), "record_id", "left_id")
    return gone.toDF("record_id", "zip", "city", "street", "name", "matched")


@check(
    "remaining_right",
    f"""WITH RECURSIVE {_PHASE1} SELECT record_id, zip, city, street, name, parent FROM r
     WHERE record_id NOT IN (SELECT right_id FROM {_BOTH1})""",
)
def remaining_right(spark, sf):
    left, right = parties(spark, sf)
    rest = matching.remaining(right, phase1_matches(spark, sf), "record_id", "right_id")
    return rest.toDF("record_id", "zip", "city", "street", "name", "parent")


@check(
    "match_output",
    f"""WITH RECURSIVE {_PHASE1} SELECT l.record_id AS pcrb_record_id, l.zip AS pcrb_zip, l.city AS pcrb_city,
     l.street AS pcrb_street, l.name AS pcrb_name, r.record_id AS dnb_record_id, r.zip AS dnb_zip, r.city AS dnb_city,
     r.street AS dnb_street, r.name AS dnb_name, r.parent AS dnb_parent, round(m.name_score, 4) AS "Similarity_Score",
     m.used_global AS "Used_Global", round(m.street_score, 4) AS "Street_Similarity",
     round(m.name_score, 4) AS "BusinessName_Similarity", m.method AS matched_method, true AS matched
     FROM ({_matched(_M1, _M2)}) m JOIN l ON l.record_id = m.left_id JOIN r ON r.record_id = m.right_id""",
)
def match_output(spark, sf):
    left, right = parties(spark, sf)
    found = _rounded(phase1_matches(spark, sf)).drop("phase")
    names_left = ["record_id", "zip", "city", "street", "name"]
    return matching.match_output(found, left.toDF(*names_left), right.toDF(*names_left, "parent"))


@check(
    "match_output_vectors",
    f"""WITH RECURSIVE {duck.parties()}, {_TEXT_VECTORS}, {duck.vector_scored("z3", "l", "r", "zip", "city")},
     {_rule("m3", rules.M3, "z3", [])}, {_rule("m4", rules.M4, "z3", ["m3"])}, {_rule("m5", rules.M5, "z3", ["m3", "m4"])}
     SELECT left_id, right_id, round(street_score, 4) AS street, CASE WHEN NOT used_global THEN round(name_score, 4) END AS name,
     CASE WHEN used_global THEN round(name_score, 4) END AS parent FROM ({_matched(*_M345)})""",
)
def match_output_vectors(spark, sf):
    left, right = parties(spark, sf)
    found = run_phase(left, right, PHASES[2])
    rows = matching.with_match_vectors(matching.match_output(found, left, right))
    own, street = F.col("pcrb_Embedding_BusinessName"), F.col("pcrb_Embedding_Street")
    through = F.col("Used_Global")
    name = similarity.cosine(own, F.col("dnb_Embedding_BusinessName"))
    parent = similarity.cosine(own, F.col("dnb_Embedding_GlobalName"))
    return rows.select(
        F.col("pcrb_record_id").alias("left_id"),
        F.col("dnb_record_id").alias("right_id"),
        F.round(similarity.cosine(street, F.col("dnb_Embedding_Street")), 4).alias("street"),
        F.when(~through, F.round(name, 4)).alias("name"),
        F.when(through, F.round(parent, 4)).alias("parent"),
    )


_HEAVY = rules.Rule("heavy", 95, 60, 60)


@check(
    "heavy_pairs",
    f"""WITH {_CLASSES.format(key="zip", other="city")}, {duck.scored("z", "lc", "rc", "zip", "city")}
     SELECT block, left_id, right_id, round(ss, 4) AS street_score, round(ns, 4) AS name_score FROM z
     WHERE ss >= 95 AND (ns >= 60 OR ps >= 60)""",
)
def heavy_pairs(spark, sf):
    """Every value pair taken as a heavy one, and a second text below the signature's range."""
    left, right = _inputs(spark, sf, PHASES[0])
    pairs = matching.fuzzy_candidates(matching.left_classes(left), matching.right_classes(right), [_HEAVY], 0)
    return rules.passing(pairs, _HEAVY).join(pairs.select("left_class", "right_class", F.col("name_score").alias("ns")), ["left_class", "right_class"]).select(
        "block", F.col("left_class").alias("left_id"), F.col("right_class").alias("right_id"),
        F.round("street_score", 4).alias("street_score"), F.round("ns", 4).alias("name_score"),
    )


#: Two fifths of the brands are one hot block, the others small blocks; Brand#1x rows are copies of one class on one side.
_BRAND_BLOCK = "CASE WHEN p_brand < 'Brand#33' THEN 'hot' ELSE p_brand END"
_LEFT_CLASS = "CASE WHEN p_brand = 'Brand#11' THEN min(p_partkey) OVER (PARTITION BY p_brand) ELSE p_partkey END"
_RIGHT_CLASS = "CASE WHEN p_brand IN ('Brand#12', 'Brand#13') THEN min(p_partkey) OVER (PARTITION BY p_brand, CASE WHEN p_brand = 'Brand#13' THEN p_size END) ELSE p_partkey END"
_BRANDS = f"""SELECT p_partkey, p_brand, p_size, p_type, {_BRAND_BLOCK} AS block, {_LEFT_CLASS} AS lc, {_RIGHT_CLASS} AS rc FROM part"""
_BRAND_PAIRS = f"""SELECT a.block, a.lc AS left_class, b.rc AS right_class, max(CASE WHEN a.p_size = b.p_size THEN 2 ELSE 1 END) AS street_score,
 max(CASE WHEN a.p_type = b.p_type THEN 2 ELSE 1 END) AS name_score FROM ({_BRANDS}) a JOIN ({_BRANDS}) b ON a.p_brand = b.p_brand
 WHERE abs(a.lc - b.rc) % 7 <> 3 GROUP BY a.block, a.lc, b.rc"""


#: Pairs of rows that a task makes.
_PAIRS_A_TASK = 4_000_000


def _class_rows(rows, keys):
    """The rows of classes, equal ones once, and whether one stands alone: a pair of such classes needs no grouping."""
    rows = rows.select(*keys, "p_brand", "p_size", "p_type").distinct()
    counts = rows.groupBy(*keys).agg((F.count("*") == 1).alias("alone"))
    return rows.join(ordering.by_shuffle(counts), keys)


@check(
    "assign_large",
    f"""WITH RECURSIVE p AS MATERIALIZED ({_BRAND_PAIRS}), c AS MATERIALIZED ({_BRANDS}), z AS MATERIALIZED (SELECT p.block, l.p_partkey AS left_id,
     r.p_partkey AS right_id, NULL AS parent, street_score::DOUBLE AS ss, name_score::DOUBLE AS ns, -1 AS ps
     FROM p JOIN c l ON l.lc = p.left_class JOIN c r ON r.rc = p.right_class),
     {_rule("m", rules.Rule("", 1.0, 1.0, 9.0), "z", [])} SELECT {_MATCH_COLUMNS} FROM m""",
)
def assign_large(spark, sf):
    """One hot block of many components, among them copies on either side, and small blocks; many equal scores, and
    several turns in most components."""
    from kinlink.operators.assign import assign

    rows = materialize(sql(spark, sf, _BRANDS), "brands")
    lefts, rights = (_class_rows(rows, keys) for keys in (["block", "lc"], ["rc"]))
    met = lefts.groupBy("p_brand").count().join(rights.groupBy("p_brand").agg(F.count("*").alias("n")), "p_brand").selectExpr("sum(count * n)", "count(*)").first()
    # a small table with far more pairs: cells of brands are dealt out, or all pairs would be made in a task or two
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (met[0] or 0) // _PAIRS_A_TASK)
    cells = 4 * tasks // max(met[1], 1) + 1
    a = lefts.withColumn("cell", F.pmod(F.xxhash64("lc"), F.lit(cells))).repartition(tasks, "p_brand", "cell")
    b = rights.withColumn("cell", F.explode(F.expr(f"sequence(0L, {cells - 1}L)"))).repartition(tasks, "p_brand", "cell")

    def scored(alone, c):
        score = F.expr(f"CASE WHEN a.{c} = b.{c} THEN 2D ELSE 1D END")
        return score if alone else F.max(score)

    def pairs_of(alone):
        both = a.alias("a").join(ordering.by_shuffle(b).alias("b"), F.expr("a.p_brand = b.p_brand AND a.cell = b.cell")).where("abs(a.lc - b.rc) % 7 <> 3")
        both = both.where(F.expr("a.alone AND b.alone") if alone else F.expr("NOT (a.alone AND b.alone)"))
        keys = [F.col("a.block").alias("block"), F.col("a.lc").alias("left_class"), F.col("b.rc").alias("right_class")]
        values = [scored(alone, "p_size").alias("street_score"), scored(alone, "p_type").alias("name_score"), F.lit(False).alias("used_global")]
        return both.select(*keys, *values) if alone else both.groupBy(*keys).agg(*values)

    pairs = pairs_of(True).unionByName(pairs_of(False))
    own = rows.select(F.col("lc").alias("left_class"), F.col("p_partkey").alias("left_id"))
    other = rows.select(F.col("rc").alias("right_class"), F.col("p_partkey").alias("right_id"))
    return _rounded(assign(materialize(pairs, "brand-pairs"), own, other, 2_500))


def _embed_tie_check() -> None:
    """Equal names, different streets: the better street wins, then the smaller id, whatever the tiles."""
    renamed = """SELECT record_id, zip, city, street, 'ACME BAKERY' AS name, NULL AS parent FROM"""
    vectors = f"""{duck.parties()}, lt AS MATERIALIZED ({renamed} l), rt AS MATERIALIZED ({renamed} r),
     {duck.vectors("SELECT street AS t FROM lt UNION SELECT name FROM lt UNION SELECT street FROM rt")},
     {duck.vector_scored("z", "lt", "rt", "zip", "city")}"""
    rule = rules.Rule("", 0.5, 0.9, 0.9)

    @check("embed_ties", f"WITH RECURSIVE {vectors}, {_rule('m', rule, 'z', [])} SELECT {_MATCH_COLUMNS} FROM m")
    def query(spark, sf):
        left, right = _inputs(spark, sf, PHASES[2])
        left = left.withColumn("name", F.lit("ACME BAKERY"))
        right = right.withColumns({"name": F.lit("ACME BAKERY"), "parent": F.lit(None).cast("string")})
        return _rounded(matching.vector_match(left, right, [rule])).drop("method")


_embed_tie_check()


_OPTIONS = """SELECT DISTINCT p_type AS code, replace(p_name, 'e', 'a') AS value FROM part"""


@check(
    "best_choice",
    f"""WITH a AS (SELECT DISTINCT p_type AS code, concat(p_type, ' ', p_name, ' co') AS value FROM part), b AS ({_OPTIONS})
     SELECT left_value, right_value, round(score, 4) AS score FROM (SELECT a.value AS left_value, b.value AS right_value,
     {duck.indel("a.value", "b.value")} AS score FROM a JOIN b USING (code))
     WHERE score >= 40 QUALIFY row_number() OVER (PARTITION BY left_value ORDER BY score DESC, right_value) = 1""",
)
def best_choice(spark, sf, counters=None):
    left, right = sql(
        spark, sf, "SELECT DISTINCT p_type AS code, concat(p_type, ' ', p_name, ' co') AS value FROM part", _OPTIONS
    )
    return best.best_in_block(left, right, "code", "ratio", cutoff=40, counters=counters).withColumn("score", F.round("score", 4))


@check(
    "name_maps",
    f"""WITH a AS (SELECT DISTINCT trim(upper(name)) AS v FROM ({NAMES}) t WHERE name IS NOT NULL),
     b AS (SELECT DISTINCT trim(upper(concat(p_name, ' ', p_type))) AS v FROM part
       UNION SELECT DISTINCT replace(upper(concat(p_name, ' b/o INCORPORATED')), 'RED', 'REDD') FROM part
       UNION SELECT DISTINCT upper(concat(p_name, CASE WHEN p_size < 25 THEN 'Inc' ELSE ' Inc' END)) FROM part),
     lo AS (SELECT v, {duck.soundex("v")} AS code FROM a WHERE v NOT IN (SELECT v FROM b)),
     ro AS (SELECT v, {duck.soundex("v")} AS code FROM b WHERE v NOT IN (SELECT v FROM a)),
     s AS MATERIALIZED (SELECT lo.v AS x, ro.v AS y, {duck.token_set("lo.v", "ro.v")} AS score FROM lo JOIN ro USING (code)),
     top AS (SELECT x, y, score FROM s QUALIFY row_number() OVER (PARTITION BY x ORDER BY score DESC, y) = 1),
     won AS (SELECT x, y, score FROM top QUALIFY row_number() OVER (PARTITION BY y ORDER BY x) = 1)
     SELECT x AS left_name, y AS right_name, round(score, 4) AS score,
     CASE WHEN score >= 90 THEN 'high' WHEN score >= 80 THEN 'med' ELSE 'low' END AS tier FROM won WHERE score >= 75""",
)
def name_maps(spark, sf, counters=None):
    left = sql(spark, sf, f"SELECT upper(name) AS v FROM ({NAMES}) t WHERE name IS NOT NULL")
    right = sql(spark, sf, 
        """SELECT upper(concat(p_name, ' ', p_type)) AS v FROM part
           UNION SELECT replace(upper(concat(p_name, ' b/o INCORPORATED')), 'RED', 'REDD') FROM part
           UNION SELECT upper(concat(p_name, CASE WHEN p_size < 25 THEN 'Inc' ELSE ' Inc' END)) FROM part"""
    )
    return names.name_maps(left, right, counters).withColumn("score", F.round("score", 4))


# --- statistics -----------------------------------------------------------------------------------------------


@check(
    "block_stats",
    f"""WITH RECURSIVE {_PHASE1},
     a AS (SELECT zip, count(*) AS n FROM l WHERE zip IS NOT NULL AND city IS NOT NULL GROUP BY zip),
     b AS (SELECT zip, count(*) AS n FROM r WHERE zip IS NOT NULL AND city IS NOT NULL GROUP BY zip),
     c1 AS (SELECT block, count(*) AS n FROM m1 GROUP BY block), c2 AS (SELECT block, count(*) AS n FROM m2 GROUP BY block),
     t AS (SELECT a.zip, a.n AS ln, b.n AS rn, coalesce(c1.n, 0) AS x1, coalesce(c2.n, 0) AS x2 FROM a JOIN b USING (zip)
       LEFT JOIN c1 ON c1.block = zip LEFT JOIN c2 ON c2.block = zip)
     SELECT zip AS "Zipcode", ln AS "Total_PCRB_Records", rn AS "Total_DNB_Records", x1 + x2 AS "Total_Matched_Records",
     x1 AS "Method1_Matched_Records", CASE WHEN ln > x1 AND rn > x1 THEN x2 END AS "Method2_Matched_Records",
     round((x1 + x2) / ln * 100, 4) AS "Match_Percentage" FROM t""",
)
def block_stats(spark, sf):
    left, right = parties(spark, sf)
    found = phase1_matches(spark, sf)
    methods = [r.method for r in PHASES[0].rules]
    table = stats.block_stats(left, right, found, "Zip_UPDATED", "City_UPDATED", methods, "Zipcode")
    return table.withColumn("Match_Percentage", F.round("Match_Percentage", 4))


@check(
    "match_rate",
    f"""WITH RECURSIVE {_PHASE1} SELECT *, round(rows_after / rows_before * 100, 4) AS percentage FROM (
     SELECT (SELECT count(*) FROM l) AS rows_before, (SELECT count(*) FROM {_BOTH1}) AS rows_after)""",
)
def match_rate(spark, sf):
    left, right = parties(spark, sf)
    before = left.agg(F.count("*").alias("rows_before"))
    after = phase1_matches(spark, sf).agg(F.count("*").alias("rows_after"))
    rate = stats.match_rate(F.col("rows_before"), F.col("rows_after"))
    return before.join(F.broadcast(after)).withColumn("percentage", F.round(rate, 4))


@check(
    "rollup_other_phase",
    """WITH f AS (SELECT l_linenumber + 1 AS phase, count(*) AS n FROM lineitem GROUP BY ALL)
     SELECT phase, before::BIGINT AS rows_before, n AS matched, (before - n)::BIGINT AS unmatched FROM (SELECT phase, n,
     (SELECT count(*) FROM lineitem) - coalesce(sum(n) OVER (ORDER BY phase ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
     AS before FROM (SELECT 1 AS phase, 0 AS n UNION ALL SELECT phase, n FROM f))""",
)
def rollup_other_phase(spark, sf):
    """Phases of any number are counted, also those that no run is told of."""
    lines = sql(spark, sf, "SELECT l_orderkey, CAST(l_linenumber + 1 AS INT) AS phase FROM lineitem")
    return stats.phase_counts(lines, lines)


@check(
    "run_rollup",
    f"""WITH RECURSIVE {_PHASE3}, f AS (SELECT phase, count(*) AS n FROM ({_matched(_M1, _M2, _N1, _N2, *_M345)}) GROUP BY phase)
     SELECT p.phase, before AS rows_before, n AS matched, before - n AS unmatched FROM (SELECT p.phase, coalesce(f.n, 0) AS n,
     (SELECT count(*) FROM l) - coalesce((SELECT sum(n) FROM f WHERE f.phase < p.phase), 0)::BIGINT AS before
     FROM (VALUES (1), (2), (3)) p(phase) LEFT JOIN f ON f.phase = p.phase) p""",
)
def run_rollup(spark, sf):
    left, right = parties(spark, sf)
    return stats.phase_counts(left, all_matches(spark, sf))


# --- the whole job ---------------------------------------------------------------------------------------------

_CITY_FIX = f"""ask AS (SELECT DISTINCT upper(trim(City)) AS city FROM ({LEFT_RAW}) t WHERE City IS NOT NULL AND City <> ''),
 ref AS (SELECT DISTINCT physical_city AS ref FROM ({RIGHT_RAW}) t),
 sim AS MATERIALIZED (SELECT city, ref, {duck.indel("cs", "rs")} AS score, {duck.soundex("city")} = {duck.soundex("ref")} AS alike
   FROM (SELECT city, ref, {duck.sorted_tokens("city")} AS cs, {duck.sorted_tokens("ref")} AS rs FROM ask, ref)),
 near AS (SELECT city, arg_min(ref, (-score, ref)) AS ref FROM sim WHERE score >= 85 GROUP BY city),
 sound AS (SELECT city, arg_min(ref, (-score, ref)) AS ref FROM sim WHERE alike GROUP BY city),
 fix AS (SELECT ask.city, coalesce(ref.ref, near.ref, sound.ref) AS fixed FROM ask LEFT JOIN ref ON ref.ref = ask.city
   LEFT JOIN near ON near.city = ask.city LEFT JOIN sound ON sound.city = ask.city)"""
_CLEAN = f"""{_CITY_FIX},
 std AS (SELECT row_number() OVER (ORDER BY FileNumber) AS rid, coalesce(nullif(Zipcode, ''), '99999') AS zip, fixed AS city,
   CAST(coalesce(nullif(regexp_replace(PrimaryFEIN, '[\\s-]+', '', 'g'), ''), '000000000') AS BIGINT) AS fein,
   {duck.common("CASE WHEN StreetAddress IN ('STATE OF PA', 'STATE OF DE', 'PA', 'DE', 'NO SPECIFIC LOCATION') THEN 'MISSING' ELSE StreetAddress END")} AS street,
   {duck.business_name("PrimaryInsuredName")} AS name, CAST(AddressTypeCode AS BIGINT) AS code
   FROM ({LEFT_RAW}) t LEFT JOIN fix ON fix.city = upper(trim(t.City))),
 kept AS (SELECT * FROM (SELECT *, max(CASE WHEN code = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY fein) AS has2,
   row_number() OVER (PARTITION BY fein ORDER BY code NULLS LAST, rid) AS rn FROM std)
   WHERE code = 2 OR (has2 = 0 AND rn = 1 AND code IS NOT NULL)),
 l AS MATERIALIZED (SELECT row_number() OVER (ORDER BY fein, rid) AS record_id, * FROM (SELECT * EXCLUDE (has2, rn) FROM kept
   QUALIFY row_number() OVER (PARTITION BY fein, street ORDER BY rid) = 1)),
 r AS MATERIALIZED (SELECT row_number() OVER (ORDER BY source_key) AS record_id, physical_city AS city,
   regexp_extract(physical_zip, '([0-9]{{5}})', 1) AS zip, {duck.common("physical_street_address")} AS street,
   {duck.business_name("business_name")} AS name, {duck.business_name("global_ultimate_name")} AS parent FROM ({RIGHT_RAW}) t)"""
_LINKED = _PHASE3.replace(duck.parties(), _CLEAN)


@once
def linkage(spark, sf):
    left, right = sql(spark, sf, LEFT_RAW, RIGHT_RAW)
    return link(left, right, ["FileNumber"], ["source_key"], Settings(abbreviations=ABBREVIATIONS))


@check(
    "link",
    f"""WITH RECURSIVE {_LINKED} SELECT m.block, l.rid AS left_id, m.right_id, round(m.street_score, 4) AS street_score,
     round(m.name_score, 4) AS name_score, m.used_global, m.method, m.phase
     FROM ({_matched(_M1, _M2, _N1, _N2, *_M345)}) m JOIN l ON l.record_id = m.left_id""",
)
def linked(spark, sf):
    return _rounded(linkage(spark, sf).matches)


@check("link_resumed", SQL["link"])
def link_resumed(spark, sf):
    """A job that stopped behind phase 2, and the run that goes on from its stored stages."""
    left, right = sql(spark, sf, LEFT_RAW, RIGHT_RAW)
    store, settings = _fresh(spark, "ledger"), Settings(abbreviations=ABBREVIATIONS)
    for now in (replace(settings, phases=settings.phases[:2]), settings):
        done = link(left, right, ["FileNumber"], ["source_key"], now, store)
    if [s.name for s in done.stages if not s.reused] != ["phase-3", "matches"]:
        raise AssertionError(f"stages built again: {done.stages}")
    return _rounded(done.matches)


@check(
    "link_metrics",
    f"""WITH RECURSIVE {_LINKED}, n AS (SELECT (SELECT count(*) FROM std) AS std, (SELECT count(*) FROM kept) AS kept,
     (SELECT count(*) FROM l) AS l, (SELECT count(*) FROM ({_matched(_M1, _M2, _N1, _N2, *_M345)})) AS m)
     SELECT 'Apply Hierarchy Method' AS description, std AS rows_before, kept AS rows_after FROM n
     UNION ALL SELECT 'Drop Duplicates', kept, l FROM n UNION ALL SELECT 'Number of matched rows', l, m FROM n
     UNION ALL SELECT 'Number of unmatched rows', l, l - m FROM n""",
)
def link_metrics(spark, sf):
    return linkage(spark, sf).metrics


@check(
    "clean_left",
    f"""WITH {_CLEAN} SELECT rid AS record_id, record_id AS match_order, fein, zip, city, street, name, code,
     concat(CAST(fein AS VARCHAR), '_', coalesce(street, '')) AS fein_address FROM l""",
)
def clean_left(spark, sf):
    return linkage(spark, sf).left.select(
        "record_id",
        "match_order",
        F.col("PrimaryFEIN").alias("fein"),
        F.col("Zip_UPDATED").alias("zip"),
        F.col("City_UPDATED").alias("city"),
        F.col("Street_UPDATED").alias("street"),
        F.col("BusinessName_UPDATED").alias("name"),
        F.col("AddressTypeCode").alias("code"),
        F.col("FEIN_Address").alias("fein_address"),
    )


@check("clean_right", f"WITH {_CLEAN} SELECT record_id, zip, city, street, name, parent FROM r")
def clean_right(spark, sf):
    return linkage(spark, sf).right.select(
        "record_id",
        F.col("Zip_UPDATED").alias("zip"),
        F.col("City_UPDATED").alias("city"),
        F.col("Street_UPDATED").alias("street"),
        F.col("BusinessName_UPDATED").alias("name"),
        F.col("GlobalName_UPDATED").alias("parent"),
    )


# --- sources and sinks -----------------------------------------------------------------------------------------

_PER_CUSTOMER = "SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS top_price FROM orders GROUP BY o_custkey"


def _fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@check("stage_cache", "SELECT o_orderkey, o_custkey, o_orderkey % 2 = 0 AS even FROM orders")
def stage_cache(spark, sf):
    """Selections of 160 columns that differ in the last one are stages of their own; asked again, each is answered from
    its own stored rows."""
    path, orders = _fresh(spark, "stage"), sql(spark, sf, "SELECT o_orderkey, o_custkey FROM orders")
    out = []
    for even in (True, False):
        wide = [F.lit(i).alias(f"c{i}") for i in range(157)]
        part = orders.select("o_orderkey", "o_custkey", *wide, ((F.col("o_orderkey") % 2 == 0) == even).alias("wanted"))
        key = tables.fingerprint(part)
        tables.cached_stage(spark, path, key, lambda part=part: part)
        stored = tables.cached_stage(spark, path, key, lambda part=part: part.limit(0))
        out.append(stored.where("wanted").select("o_orderkey", "o_custkey", F.lit(even).alias("even")))
    return out[0].unionByName(out[1])


@check("snapshot", _PER_CUSTOMER)
def snapshot(spark, sf):
    path = _fresh(spark, "snapshot")
    tables.save_snapshot(sql(spark, sf, _PER_CUSTOMER), path)
    return tables.load_snapshot(spark, path)


_STATS = "SELECT l_returnflag AS name, count(*) AS n, l_linenumber % 3 + 1 AS phase FROM lineitem GROUP BY ALL"


@check("stats_sink", _STATS)
def stats_sink(spark, sf):
    path, rows = _fresh(spark, "stats"), sql(spark, sf, _STATS)
    tables.write_stats(rows.unionByName(rows.withColumn("phase", F.lit(4).cast(rows.schema["phase"].dataType))), path)
    tables.write_stats(rows.where("phase = 2"), path, [2, 4])
    return tables.read_matches(spark, path)


@check("append_table", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def append_table(spark, sf):
    name = f"appended_{uuid.uuid4().hex}"
    for _ in range(2):
        tables.append_table(sql(spark, sf, "SELECT s_suppkey, s_name FROM supplier"), name)
    return spark.table(name)


@check(
    "ddl",
    """SELECT 'CREATE TABLE IF NOT EXISTS linked (left_id INTEGER, block STRING, street_score FLOAT, phase INTEGER);'
     AS statement, (SELECT count(*) FROM lineitem) AS n_rows""",
)
def ddl(spark, sf):
    rows = sql(spark, sf, """SELECT l_orderkey AS left_id, l_returnflag AS block, CAST(l_tax AS FLOAT) AS street_score,
     CAST(l_linenumber AS INT) AS phase FROM lineitem""")
    statement = tables.create_table_sql("linked", rows.schema)
    return rows.agg(F.lit(statement).alias("statement"), F.count("*").alias("n_rows"))


def _lines_of(df: DataFrame, path: str) -> str:
    """One file of lines, so that a lookup of the tables' own words can be read back."""
    df.coalesce(1).write.text(path)
    return next(f for f in df.sparkSession.read.text(path).inputFiles())


@check(
    "word_file",
    "SELECT DISTINCT upper(split_part(p_name, ' ', 2)) AS word FROM part UNION SELECT DISTINCT upper(n_name) FROM nation",
)
def word_file(spark, sf):
    lines = sql(
        spark, sf, """SELECT DISTINCT concat('\t', split_part(p_name, ' ', 2), ' ') AS value FROM part
         UNION ALL SELECT concat(lower(n_name), '\t') FROM nation"""
    )
    words = lookups.load_words(spark, _lines_of(lines, _fresh(spark, "words")))
    return spark.createDataFrame([(w,) for w in words], "word string")


@check(
    "sheet_file",
    """SELECT word, abbreviation FROM (SELECT concat(n_name, ', ', n_nationkey) AS word, concat('N', n_nationkey) AS abbreviation
     FROM nation UNION ALL SELECT concat('X', n_nationkey), concat('N', n_nationkey) FROM nation)""",
)
def sheet_file(spark, sf):
    body = sql(
        spark, sf, """SELECT concat('"', n_name, ', ', n_nationkey, '",X', n_nationkey, ',N', n_nationkey) AS value FROM nation"""
    )
    head = spark.createDataFrame([("a",), ("b",), ("c",), ('"Primary, long",Common,Standard',)], "value string").coalesce(1)
    path = _lines_of(head.unionByName(body), _fresh(spark, "sheet"))
    mapping = lookups.abbreviation_mapping(lookups.load_abbreviation_sheet(spark, path))
    return spark.createDataFrame(list(mapping.items()), "word string, abbreviation string")


@check(
    "match_sink",
    f"WITH RECURSIVE {_PHASE1} SELECT left_id, right_id, method, phase FROM ({_matched(_M1, _M2)})",
)
def match_sink(spark, sf):
    """Published matches, and a rerun that was cut off before it published: readers see nothing of it."""
    path, rows = _fresh(spark, "match-file"), phase1_matches(spark, sf).select("left_id", "right_id", "method", "phase")
    tables.write_matches(rows, path, "csv")
    rows.withColumn("method", F.lit("cut off")).write.partitionBy("phase").csv(f"{path}/run-csv-cut")
    return tables.read_matches(spark, path)


@check(
    "metrics_log",
    """SELECT o_orderpriority AS "Description of Operation", count(*) AS "Rows Before",
     count(*) FILTER (o_orderstatus = 'F') AS "Rows After",
     round(count(*) FILTER (o_orderstatus = 'F') / count(*) * 100, 4) AS "Percentage Change" FROM orders GROUP BY ALL""",
)
def metrics_log(spark, sf):
    counts = sql(
        spark,
        sf,
        """SELECT o_orderpriority AS description, count(*) AS rows_before,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS rows_after FROM orders GROUP BY ALL""",
    )
    path = _fresh(spark, "metrics")
    log_metrics(counts, path, "run-1")
    log_metrics(counts, path, "run-2")
    report = read_metrics(spark, path, "run-2").drop("Timestamp")
    return report.withColumn("Percentage Change", F.round("Percentage Change", 4))
