"""Judging URLs: rules by host and path, then naive Bayes over the words that a unigram Viterbi finds in them.

Names such as ``cheappills`` are split into the words that make them most probable under unigram counts. Counts come from
a table of words of any size; only those that occur inside a name are brought together with it, by a join on substrings.
The words of host and path are scored by multinomial naive Bayes, fitted on a small labelled table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.storage import materialize

LONGEST = 20  # letters of a word that a name may hold
PIECE = 1_000  # letters of a name that are cut into substrings at once
#: Action, host and path of each rule (fixed values; a parameter of ``judged``).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Words of labelled URLs, a line for each URL (fixed values; a parameter of ``fit_bayes``).
LABELLED = {
    "block": """
        cheap pills online pharmacy
        buy viagra cheap
        best casino bonus win
        online poker bet
        free porn videos xxx
        adult cam sex
        payday loans fast cash
        replica watches cheap sale
        torrent download crack keygen
        hot singles dating adult
        lottery jackpot win money
        weight loss pills miracle
        spam click bonus offer
        casino slots free spins
        malware download free crack
        cheap cigarettes discount pills
    """,
    "allow": """
        news world politics article
        school library books
        blog travel photos
        docs guide reference manual
        health clinic doctor
        university research science
        music review album
        food recipes kitchen
        city council services
        shop garden tools
        forum help questions
        weather today report
        sports results football
        museum history art
        company about contact
        wiki page index
    """,
}
_SITE = ["www", "com", "org", "net", "html", "htm", "php", "index", "blog", "en", "de", "fr", "es", "m", "example"]
#: How often each labelled word counts beside the corpus, as a share of all its words.
_SHARE = 1e-3


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path. Null or without ``://``: both empty."""
    text = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    pattern = "://([^/?#]*)([^?#]*)"
    lower = F.translate(F.regexp_extract(text, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(text, pattern, 2)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, action) of the longest rule that fits, or null; of rules of one length the alphabetically last."""
    known = [F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path")) for a, h, p in rules]
    if not known:
        return F.lit(None).cast("struct<n:int,rule:string,action:string,host:string,path:string>")
    fits = F.filter(
        F.array(*known),
        lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]),
    )
    return F.array_max(fits)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts: words of a-z only after lower-casing, up to ``LONGEST`` letters."""
    words = docs.select(F.explode(F.split(F.lower(F.col(f"`{text}`")), r"[\s\p{Punct}]+")).alias("word"))
    return words.where(F.col("word").rlike(f"^[a-z]{{1,{LONGEST}}}$")).groupBy("word").agg(F.count("*").alias("n"))


def fit_bayes(labelled: dict[str, str] | None = None) -> tuple[dict[str, float], float]:
    """Log-odds of block against allow for each labelled word (add-one smoothing), and those of the classes."""
    lines = {c: [x.split() for x in t.splitlines() if x.strip()] for c, t in (labelled or LABELLED).items()}
    seen = {c: Counter(w for x in rows for w in x) for c, rows in lines.items()}
    vocabulary = sorted({*seen["block"], *seen["allow"]})
    total = {c: sum(n.values()) + len(vocabulary) for c, n in seen.items()}
    odds = {w: log((seen["block"][w] + 1) / total["block"]) - log((seen["allow"][w] + 1) / total["allow"]) for w in vocabulary}
    # most addresses are harmless: a name without known words is allowed
    return odds, log(len(lines["block"]) / len(lines["allow"])) - 0.5


def best_split(name: str, known: dict[str, int], total: int) -> list[str]:
    """The most probable words of ``name`` by Viterbi; unknown stretches pay ten times more for each letter."""
    best = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        options = []
        for start in range(max(0, end - LONGEST), end):
            word = name[start:end]
            n = known.get(word)
            chance = log(n / total) if n else log(10 / total) - len(word) * log(10)
            options.append((best[start][0] + chance, start))
        best.append(max(options))
    words, end = [], len(name)
    while end:
        words.append(name[best[end][1] : end])
        end = best[end][1]
    return words[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) for every distinct ``name`` of a-z. ``counts`` has (word, n); its size does not matter."""
    distinct = names.where("name is not null and name <> ''").select("name").distinct()
    distinct = distinct.withColumn("id", F.sha2("name", 256))
    total = max(counts.agg(F.sum("n")).first()[0] or 0, 1)
    # a long name goes in pieces that overlap by a word, and only its digest goes with its substrings
    pieces = f"transform(sequence(0, (length(name) - 1) div {PIECE}), i -> substring(name, i * {PIECE} + 1, {PIECE + LONGEST - 1}))"
    spans = distinct.select("id", F.explode(F.expr(pieces)).alias("piece"))
    spans = spans.withColumn("start", F.explode(F.sequence(F.lit(1), F.length("piece"))))
    reach = F.least(F.lit(LONGEST), F.length("piece") - F.col("start") + 1)
    spans = spans.withColumn("size", F.explode(F.sequence(F.lit(1), reach)))
    inside = spans.select("id", F.expr("substring(piece, start, size)").alias("word")).distinct()
    hits = inside.join(counts, "word").groupBy("id").agg(
        F.collect_list("word").alias("known"), F.collect_list("n").alias("counts")
    )

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for name, known, n in batches:
            rows = zip(name.to_pylist(), known.to_pylist(), n.to_pylist())
            yield pa.array([best_split(x, dict(zip(w or (), c or ())), total) for x, w, c in rows], pa.list_(pa.string()))

    return distinct.join(hits, "id", "left").select("name", split("name", "known", "counts").alias("words"))


def _names(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z]+"), lambda w: w != "")


def judged(pages: DataFrame, counts: DataFrame, rules: list[tuple[str, str, str]] | None = None, labelled: dict[str, str] | None = None, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict, words and score (columns of these names are replaced).

    A rule decides where one fits, else the sum of the words' log-odds. Hosts and paths are scored once for each distinct
    one; null urls and those without ``://`` have empty parts, no words and the verdict of the classes' odds.
    """
    spark = pages.sparkSession
    odds, prior = fit_bayes(labelled)
    counts = materialize(counts, "word-counts")  # of all documents, and asked three times
    total = counts.agg(F.sum("n")).first()[0] or 0
    extra = [(w, max(1, int(total * _SHARE))) for w in dict.fromkeys([*odds, *_SITE])]
    known = counts.unionByName(spark.createDataFrame(extra, "word string, n long"))
    known = known.groupBy("word").agg(F.sum("n").alias("n"))
    host, path = parts(url)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "words", "score")]
    split = pages.select(*(F.col(f"`{c}`") for c in kept), host.alias("host"), path.alias("path"))
    split = split.withColumn("_path_words", F.array_join(_names(F.col("path")), " "))
    texts = split.select("host").unionByName(split.select(F.col("_path_words").alias("host"))).distinct()
    names = texts.select(F.col("host").alias("of"), F.explode(_names(F.col("host"))).alias("name"))
    words = names.join(segmented(names, known), "name").select("of", F.explode("words").alias("word"))
    weights = spark.createDataFrame(sorted(odds.items()), "word string, odds double")
    scored = words.join(F.broadcast(weights), "word", "left").groupBy("of").agg(
        F.round(F.sum(F.coalesce("odds", F.lit(0.0))), 9).alias("score"), F.array_sort(F.collect_list("word")).alias("words")
    )
    of_host = scored.select(F.col("of").alias("host"), F.col("score").alias("_host_score"), F.col("words").alias("_host_found"))
    of_path = scored.select(F.col("of").alias("_path_words"), F.col("score").alias("_path_score"), F.col("words").alias("_path_found"))
    joined = split.join(of_host, "host", "left").join(of_path, "_path_words", "left")
    score = F.coalesce("_host_score", F.lit(0.0)) + F.coalesce("_path_score", F.lit(0.0)) + prior
    none = F.array().cast("array<string>")
    rule = fitting_rule(F.col("host"), F.col("path"), RULES if rules is None else rules)
    out = joined.withColumns({"_rule": rule, "score": score, "words": F.concat(F.coalesce("_host_found", none), F.coalesce("_path_found", none))})
    verdict = F.coalesce(F.col("_rule.action"), F.when(F.col("score") > 0, "block").otherwise("allow"))
    return out.select(*(F.col(f"`{c}`") for c in kept), "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), "words", "score")
