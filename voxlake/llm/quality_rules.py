"""Quality rules as a short-circuit cascade.

Each rule is a predicate that rejects a document. On a sample, the share of documents that a rule rejects and the time
it takes are measured; rules run in the order of rejections per cost, and a document that one rule rejects is not
shown to the later ones. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.native import GAPS, count_of, let, word_list

SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]+"
#: A-Z and the capitals of Latin-1.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
#: Documents, about, on which costs and selectivities are estimated.
SAMPLE_ROWS = 1000


def repeat_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of `width` words that occurs twice or more in the list, the first included."""

    def covered(spots: Column) -> Column:
        reach = F.transform(spots, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(spots, i + 1) - p, F.lit(width))))
        return F.aggregate(reach, F.lit(0), lambda a, x: a + x)

    def repeated(windows: Column) -> Column:
        same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
        twice = F.filter(windows, lambda x, i: same(x, F.get(windows, i - 1)) | same(x, F.get(windows, i + 1)))
        return let(F.sort_array(F.transform(twice, lambda x: x["p"])), covered)

    def windows(ws: Column) -> Column:
        spots = F.sequence(F.lit(0), F.size(ws) - width)
        return F.sort_array(F.transform(spots, lambda p: F.struct(F.xxhash64(*(F.get(ws, p + k) for k in range(width))).alias("h"), p.alias("p"))))

    return let(words, lambda ws: F.when(F.size(ws) < width, F.lit(0)).otherwise(let(windows(ws), repeated))).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines (split at \\n) with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, GAPS, " " * len(GAPS))) != "")
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def word_chars(text: Column) -> Column:
    return F.char_length(F.translate(text, GAPS + " ", "")).cast("long")


def statistics(text: Column, words: Column, n_words: Column) -> dict[str, Column]:
    """What rules look at, by name, as expressions over the text, its words and their number; only n_repeat_words needs the words themselves."""
    return {
        "n_words": n_words,
        "word_chars": word_chars(text),
        "n_symbols": count_of(text, SYMBOLS),
        "n_lines": F.size(F.split(text, "\n")),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeat_words(words),
        "capitals": count_of(text, CAPITALS),
        "exclamations": count_of(text, "!"),
    }


Rule = Callable[[dict[str, Column]], Column]
#: Name -> predicate over the statistics, true where the rule rejects the document.
DEFAULT_RULES: dict[str, Rule] = {
    "few_words": lambda s: s["n_words"] < 50,
    "repeated_words": lambda s: 100 * s["n_repeat_words"] > 50 * s["n_words"],
    "symbols": lambda s: 10 * s["n_symbols"] > s["n_words"],
    "word_length": lambda s: ~s["word_chars"].between(2 * s["n_words"], 14 * s["n_words"]),
    "duplicate_lines": lambda s: 3 * s["n_dup_lines"] > s["n_lines"],
    "capitals": lambda s: 10 * s["capitals"] > 3 * s["word_chars"],
    "exclamations": lambda s: 5 * s["exclamations"] > s["n_words"],
}


def plan_cascade(docs: DataFrame, rules: dict[str, Rule], sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """The rules in the order of rejections per second on a sample of about `sample_rows` documents: name, cost in seconds, share rejected.

    A rule's cost is what it takes beyond a job that only counts the words, which all of them need.
    """
    total = docs.count()
    if not total:
        return [{"name": n, "cost": 0.0, "share": 0.0} for n in rules]
    sample = docs.select(F.coalesce("text", F.lit("")).alias("text")).sample(min(1.0, sample_rows / total), seed=17).persist()
    seen = max(1, sample.count())

    def timed(rule: Rule) -> tuple[float, int]:
        began = time.perf_counter()
        rejected = sample.agg(F.count_if(_judged(F.col("text"), rule))).first()[0]
        return time.perf_counter() - began, rejected

    bare = lambda s: s["n_words"] < 0
    timed(bare)  # compiles what all rules share
    base = min(timed(bare)[0] for _ in range(2))
    found = [{"name": name, "cost": max(took - base, 1e-3), "share": rejected / seen} for name, (took, rejected) in ((n, timed(r)) for n, r in rules.items())]
    sample.unpersist()
    return sorted(found, key=lambda r: (-r["share"] / r["cost"], r["name"]))


def _judged(text: Column, rule: Callable[[dict[str, Column]], Column]) -> Column:
    """What a rule, or a cascade of them, says of a text; its words are counted once, and listed only where a rule gets to look at them."""
    return let(F.regexp_count(text, F.lit(WORD)).cast("long"), lambda n: rule(statistics(text, word_list(text), n)))


def cascade(plan: list[dict], rules: dict[str, Rule], given: dict[str, Column]) -> Column:
    """The name of the first rule, in the planned order, that rejects the document; null where all let it pass. Later rules are not evaluated for a rejected document."""
    out = F
    for step in plan:
        out = out.when(rules[step["name"]](given), F.lit(step["name"]))
    return out if plan else F.lit(None).cast("string")


def filter_documents(docs: DataFrame, rules: dict[str, Rule] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of `docs` that every rule lets pass, with all their columns. Null and empty texts have few words, a very long one is judged whole; repeated rows and null doc_ids are judged alike; an empty table stays empty."""
    plan = plan_cascade(docs, rules, sample_rows)
    return docs.where(_judged(F.coalesce(docs["text"], F.lit("")), lambda s: cascade(plan, rules, s).isNull()))


def measure(docs: DataFrame, rules: dict[str, Rule] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """For each row of `docs` (doc_id and text are read): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, reason.

    base_failed: fewer than 50 words, or more than half of them in repeated windows of three words. reason: the rule that
    rejected the document, null where kept; where several would, the one given may differ from run to run. A null text has no words and fails; a very long one is
    measured whole. Null doc_ids and repeated rows are kept as they are, other columns aren't read; an empty table gives an empty result.
    """
    base = ("few_words", "repeated_words")
    rest = {n: r for n, r in rules.items() if n not in base}
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    given = statistics(F.col("text"), word_list(F.col("text")), F.lit(0))
    counts = let(word_list(F.col("text")), lambda w: F.struct(F.size(w).cast("long"), repeat_words(w), given["word_chars"], given["n_symbols"], given["n_dup_lines"]))
    # the generator keeps the optimizer from evaluating the counts once for each use
    names = ["n_words", "n_repeat_words", "word_chars", "n_symbols", "n_dup_lines"]
    counted = docs.select("doc_id", "text", F.inline(F.array(counts)).alias(*names))
    given |= {n: F.col(n) for n in names}
    failed = DEFAULT_RULES["few_words"](given) | DEFAULT_RULES["repeated_words"](given)
    verdict = F.when(DEFAULT_RULES["few_words"](given), F.lit("few_words")).when(failed, F.lit("repeated_words"))
    if rest:
        verdict = F.coalesce(verdict, cascade(plan_cascade(docs, rest, sample_rows), rest, given))
    out = counted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), F.inline(F.array(F.struct(verdict.alias("reason")))))
    return out.withColumn("kept", F.col("reason").isNull())


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measure(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.drop("reason")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
p AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, sum(least(3, coalesce(n - i, 3))) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM p) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
  length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ', '')) AS capitals,
  length(t) - length(replace(t, '!', '')) AS exclamations, len(string_split(t, chr(10))) AS n_lines
  FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR NOT word_chars BETWEEN 2 * n_words AND 14 * n_words OR 3 * n_dup_lines > n_lines
    OR 10 * capitals > 3 * word_chars OR 5 * exclamations > n_words) AS kept
FROM b
"""
