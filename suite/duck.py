"""DuckDB expressions that say the same as the Spark operators, written independently of them."""

from kinlink.functions import text
from suite.parties import ABBREVIATIONS, LEFT_PARTY, RIGHT_PARTY


def replace_all(c: str, pattern: str, value: str) -> str:
    return f"regexp_replace({c}, '{pattern}', '{value}', 'g')"


def squeeze(c: str) -> str:
    return f"trim({replace_all(c, chr(92) + 's+', ' ')})"


def common(c: str) -> str:
    c = replace_all(f"regexp_replace(upper({c}), '^\\s*\\([^)]*\\)\\s*', '')", "\\.+", " ")
    for word, value in text.DIRECTIONS.items():
        c = replace_all(c, f"\\b{word}\\b", value)
    for word, value in ABBREVIATIONS.items():
        c = replace_all(c, f"\\b{word}\\b", f" {value} ")
    return squeeze(c)


def full_address(c: str) -> str:
    return f"replace({common(c)}, ',', '')"


def no_numbers(c: str) -> str:
    c = common(c)
    for pattern in text.STREET_NUMBER_PATTERNS:
        c = replace_all(c, pattern, "")
    return squeeze(c)


def number_words(c: str) -> str:
    for word, value in text.NUMBER_WORDS.items():
        c = replace_all(c, f"\\b{word}\\b", value)
    return c


def suffix_split(c: str) -> str:
    for suffix in ("INCORPORATED", "LIMITED", "CORP", "INC", "LLC", "LTD"):
        c = replace_all(c, f"(\\w+)({suffix})\\b", "\\1 \\2")
    return c


def without_common(c: str) -> str:
    for word in text.COMMON_WORDS:
        c = replace_all(c, f"\\b{word}\\b", "")
    return squeeze(c)


def business_name(c: str) -> str:
    c = suffix_split(number_words(f"upper({c})"))
    for suffix in text.LEGAL_SUFFIXES:
        c = replace_all(c, f"\\b{suffix}\\b", "")
    for word, value in [*text.DIRECTIONS.items(), *ABBREVIATIONS.items()]:
        c = replace_all(c, f"\\b{word}\\b", value)
    return squeeze(replace_all(without_common(c), "[^0-9A-Z\\s]", ""))


def lcs(a: str, b: str) -> str:
    full = f"((1::HUGEINT << length({a})) - 1)"
    mask = (
        f"coalesce(list_sum(list_transform(range(1, length({a}) + 1), lambda i: "
        f"CASE WHEN {a}[i] = ch THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END)), 0)::HUGEINT"
    )
    steps = f"list_prepend({full}, list_transform(str_split({b}, ''), lambda ch: {mask}))"
    state = f"list_reduce({steps}, lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full})"
    return f"(length({a}) - bit_count({state}))"


def indel(a: str, b: str) -> str:
    total = f"(length({a}) + length({b}))"
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 0.0::DOUBLE WHEN {a} = {b} THEN 100.0::DOUBLE ELSE "
        f"100.0::DOUBLE * (1.0::DOUBLE - ({total} - 2 * {lcs(a, b)})::DOUBLE / {total}) END"
    )


def sorted_tokens(c: str) -> str:
    return f"array_to_string(list_sort(list_filter(str_split({c}, ' '), lambda w: w <> '')), ' ')"


def token_set(a: str, b: str) -> str:
    """Best of the three ratios over a subquery that names the sorted shared and unshared words."""
    return f"""(SELECT CASE WHEN len(xs) = 0 OR len(ys) = 0 THEN 0.0::DOUBLE
      WHEN len(s) > 0 AND (len(xo) = 0 OR len(yo) = 0) THEN 100.0::DOUBLE
      WHEN len(s) = 0 THEN {indel('jx', 'jy')}
      ELSE greatest({indel('jx', 'jy')}, {indel('js', 'jx')}, {indel('js', 'jy')}) END
     FROM (SELECT *, array_to_string(s, ' ') AS js, array_to_string(list_concat(s, xo), ' ') AS jx,
            array_to_string(list_concat(s, yo), ' ') AS jy
       FROM (SELECT xs, ys, list_sort(list_intersect(xs, ys)) AS s,
              list_sort(list_filter(xs, lambda w: NOT list_contains(ys, w))) AS xo,
              list_sort(list_filter(ys, lambda w: NOT list_contains(xs, w))) AS yo
         FROM (SELECT list_distinct(list_filter(str_split({a}, ' '), lambda w: w <> '')) AS xs,
                      list_distinct(list_filter(str_split({b}, ' '), lambda w: w <> '')) AS ys))))"""


def soundex(c: str) -> str:
    """Digits per letter, H and W dropped, runs collapsed, vowels and other characters as separators."""
    other = f"regexp_replace(substr(upper({c}), 2), '[HW]', '', 'g')"
    first = f"substr(upper({c}), 1, 1)"

    def code(e: str) -> str:
        letters = f"regexp_replace({e}, '[^A-Z]', '0', 'g')"
        return f"translate({letters}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230120022455012623010202')"

    digits = f"regexp_replace({code(other)}, '[^1-6]', '0', 'g')"
    lead = f"regexp_replace({code(first)}, '[^1-6]', '0', 'g')"
    runs = f"{lead} || {digits}"
    for d in "123456":
        runs = f"regexp_replace({runs}, '{d}+', '{d}', 'g')"
    body = f"regexp_replace(substr({runs}, 2), '0', '', 'g')"
    return f"CASE WHEN {c} = '' THEN '' ELSE rpad({first} || substr({body}, 1, 3), 4, '0') END"


def parties() -> str:
    """CTEs ``l`` and ``r`` with match keys."""
    return f"""
l AS (SELECT record_id, zip, city, {common('street')} AS street, {business_name('name')} AS name FROM ({LEFT_PARTY}) x),
r AS (SELECT record_id, zip, city, {common('street')} AS street, {business_name('name')} AS name,
      {business_name('parent')} AS parent FROM ({RIGHT_PARTY}) x)"""


def scored(tag: str, left: str, right: str, key: str, other: str) -> str:
    """CTE of all pairs in a block with their string scores."""
    return f"""
{tag} AS MATERIALIZED (SELECT l.{key} AS block, l.record_id AS left_id, r.record_id AS right_id, r.parent AS parent,
    {indel('l.street', 'r.street')} AS ss, {indel('l.name', 'r.name')} AS ns, {indel('l.name', 'r.parent')} AS ps
  FROM {left} l JOIN {right} r ON l.{key} = r.{key} WHERE l.{other} IS NOT NULL AND r.{other} IS NOT NULL)"""


def passing(tag: str, source: str, street: float, name: float, parent: float, without: list[str]) -> str:
    """CTE of pairs that pass a rule and touch no row of earlier matches."""
    free = "".join(
        f" AND left_id NOT IN (SELECT left_id FROM {m}) AND right_id NOT IN (SELECT right_id FROM {m})"
        for m in without
    )
    return f"""
{tag} AS MATERIALIZED (SELECT block, left_id, right_id, ss AS street_score,
    CASE WHEN ns >= {name} THEN ns ELSE ps END AS name_score, NOT (ns >= {name}) AS used_global
  FROM {source} WHERE ss >= {street} AND (ns >= {name} OR (parent IS NOT NULL AND ps >= {parent})){free})"""


def choose(tag: str, pairs: str) -> str:
    """CTEs that let left rows choose one after the other."""
    return f"""
{tag}_turn AS MATERIALIZED (SELECT row_number() OVER (ORDER BY left_id) AS k, left_id, wishes FROM (
    SELECT left_id, list(right_id ORDER BY name_score DESC, street_score DESC, right_id) AS wishes
    FROM {pairs} GROUP BY left_id)),
{tag}_walk(k, left_id, right_id, taken) AS (
  SELECT 0::BIGINT, NULL::BIGINT, NULL::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT k, left_id, pick, CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick) END FROM (
    SELECT t.k, t.left_id, w.taken, list_filter(t.wishes, lambda x: NOT list_contains(w.taken, x))[1] AS pick
    FROM {tag}_walk w JOIN {tag}_turn t ON t.k = w.k + 1)),
{tag} AS MATERIALIZED (SELECT p.* FROM {tag}_walk w JOIN {pairs} p ON p.left_id = w.left_id AND p.right_id = w.right_id)"""


def rest(tag: str, source: str, side: str, matches: list[str]) -> str:
    tests = " AND ".join(f"record_id NOT IN (SELECT {side}_id FROM {m})" for m in matches)
    return f"\n{tag} AS MATERIALIZED (SELECT * FROM {source} WHERE {tests})"


def vector(c: str) -> str:
    """Counts of hashed trigrams as 256 FLOATs of length one."""
    padded = f"('  ' || {c} || ' ')"
    slots = (
        f"list_transform(range(1, length({padded}) - 1), lambda i: "
        f"('0x' || substr(md5(substr({padded}, i, 3)), 1, 2))::INT)"
    )
    return f"list_transform(range(0, 256), lambda b: len(list_filter({slots}, lambda x: x = b)))::DOUBLE[]"


def vectors(texts: str) -> str:
    return f"""
texts AS (SELECT DISTINCT t FROM ({texts}) WHERE t IS NOT NULL),
counted AS MATERIALIZED (SELECT t, {vector('t')} AS v FROM texts),
vec AS MATERIALIZED (SELECT t, list_transform(v, lambda x: (x / sqrt(list_sum(list_transform(v, lambda y: y * y))))::FLOAT)::DOUBLE[] AS v FROM counted)"""


def vector_scored(tag: str, left: str, right: str, key: str, other: str) -> str:
    return f"""
{tag} AS MATERIALIZED (SELECT l.{key} AS block, l.record_id AS left_id, r.record_id AS right_id, r.parent AS parent,
    round(list_cosine_similarity(ls.v, rs.v), 9) AS ss, coalesce(round(list_cosine_similarity(ln.v, rn.v), 9), -1) AS ns,
    coalesce(round(list_cosine_similarity(ln.v, rp.v), 9), -1) AS ps
  FROM {left} l JOIN {right} r ON l.{key} = r.{key}
  JOIN vec ls ON ls.t = l.street JOIN vec ln ON ln.t = l.name JOIN vec rs ON rs.t = r.street
  LEFT JOIN vec rn ON rn.t = r.name LEFT JOIN vec rp ON rp.t = r.parent
  WHERE l.{other} IS NOT NULL AND r.{other} IS NOT NULL)"""
