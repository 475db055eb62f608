"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Only DataFrame and SQL functions.  Each rule votes 1 (good), 0 (bad) or abstains
(-1).  The documents are counted by their pattern of votes (at most 3**rules rows,
whatever the corpus size); on that table EM estimates the share of good text and
each rule's two accuracies, how often its vote is right on good and on bad text (a
rule that knows one kind of junk is right on few bad texts, yet its bad vote means
much), and each document's posterior follows from its votes.

All thresholds compare whole numbers, so every engine decides alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm import scratch

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MARKED = "[#*$%&|<>]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FUNCTION_WORDS = ("the of and to in is that for it as with was on are by this be at from or an "
                  "de la le les et des en un une du que est pour dans qui sur pas au avec "
                  "der die und den von zu mit das dem nicht ein eine auf für ist im sich "
                  "el los del las por con una para su lo al como más se no").split()

#: (rule, votes bad if, votes good if): SQL that Spark and DuckDB read alike, over the counts of ``counted``.
RULES = (
    ("symbols", "100 * n_symbols > 10 * word_chars", "100 * n_symbols <= word_chars"),
    ("marked_words", "100 * n_marked > 30 * n_words", "100 * n_marked <= 2 * n_words"),
    ("lines", "10 * n_dup_lines >= 3 * n_lines", "n_dup_lines = 0 AND n_lines >= 3"),
    ("repeats", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    ("word_length", "word_chars < 3 * n_words OR word_chars > 12 * n_words", "word_chars >= 4 * n_words AND word_chars <= 9 * n_words"),
    ("case", "100 * n_upper > 40 * word_chars", "100 * n_upper <= 15 * word_chars"),
    ("shouting", "10 * n_exclaim > 3 * n_words", "20 * n_exclaim <= n_words"),
    ("variety", "100 * n_distinct < 20 * n_words", "100 * n_distinct >= 40 * n_words"),
    ("function_words", "n_function = 0 AND n_words >= 50", "100 * n_function >= 5 * n_words"),
)
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
ROUNDS, START_PRIOR, START_GOOD, START_BAD = 20, 0.85, 0.95, 0.4
KEEP_AT = 0.5


def counted(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each whole text (null: empty)."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = text.select("doc_id", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
                        F.filter(F.split("text", "\n"), lambda s: s.rlike(WORD)).alias("lines"))
    hashed = words.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    windows = hashed.select("*", F.when(F.size("hashes") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("hashes") - 3),
        lambda i: F.xxhash64(F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2)))).alias("windows"))
    # most texts repeat no window; the others sort (hash, place) and keep the places whose neighbour has the same hash
    ordered = windows.select("*", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.array_sort(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))).alias("ordered"))
    twice = F.filter(F.transform("ordered", lambda s, k: F.when(
        (F.get("ordered", k - 1)["h"] == s["h"]) | (F.get("ordered", k + 1)["h"] == s["h"]), s["p"])), lambda p: p.isNotNull())
    placed = ordered.select("*", F.array_sort(twice).alias("places"))
    covered = F.aggregate("places", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                          lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])
    chars: Column = F.length("text")
    without = lambda signs: F.length(F.translate("text", signs, ""))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": chars - without(SYMBOLS),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("lines"),
        "n_upper": chars - without(UPPER),
        "n_exclaim": chars - without("!"),
        "n_distinct": F.size(F.array_distinct("hashes")),
        "n_marked": F.size(F.filter("words", lambda w: w.rlike(MARKED))),
        "n_function": F.size(F.filter("words", lambda w: w.isin(FUNCTION_WORDS))),
    }
    return placed.select("doc_id", *[c.cast("long").alias(n) for n, c in counts.items()])


def votes(counts: DataFrame) -> DataFrame:
    """The counts with one column ``v_<rule>`` for each rule; a text without words has only abstentions."""
    return counts.withColumns({f"v_{name}": F.expr(f"CASE WHEN n_words = 0 THEN -1 WHEN {bad} THEN 0 WHEN {good} THEN 1 ELSE -1 END")
                               for name, bad, good in RULES})


def estimate(voted: DataFrame) -> DataFrame:
    """One row: ``prior`` (share of good text), ``good`` and ``bad`` (arrays: how often a rule's vote is right on
    either), after ``ROUNDS`` of EM.  The vote patterns are a bounded array in that row, the rounds a fold over it.
    """
    columns = [f"v_{name}" for name, *_ in RULES]
    patterns = voted.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    table = patterns.agg(F.collect_list(F.struct(F.array(*columns).alias("v"), F.col("n").cast("double").alias("n"))).alias("found"))

    def product(p: Column, right: Column, side: int) -> Column:
        chance = lambda v, a: F.when(v == side, a).when(v == 1 - side, 1 - a).otherwise(F.lit(1.0))
        return F.aggregate(F.zip_with(p["v"], right, chance), F.lit(1.0), lambda x, y: x * y)

    def posterior(p: Column, state: Column) -> Column:
        good, bad = state["prior"] * product(p, state["good"], 1), (1 - state["prior"]) * product(p, state["bad"], 0)
        return good / (good + bad)

    def total(weighed: Column, value) -> Column:
        return F.aggregate(F.transform(weighed, value), F.lit(0.0), lambda x, y: x + y)

    def rate(weighed: Column, j: int, side: int) -> Column:
        """How often rule j votes ``side`` where that is right; smoothed by one right and one wrong vote."""
        share = lambda w: w["n"] * (w["q"] if side else 1 - w["q"])
        right = total(weighed, lambda w: F.when(w["v"][j] == side, share(w)).otherwise(F.lit(0.0)))
        cast = total(weighed, lambda w: F.when(w["v"][j] >= 0, share(w)).otherwise(F.lit(0.0)))
        return (right + 1) / (cast + 2)

    def maximise(weighed: Column) -> Column:
        good, everything = total(weighed, lambda w: w["n"] * w["q"]), total(weighed, lambda w: w["n"])
        return F.struct(((good + 1) / (everything + 2)).alias("prior"),
                        F.array(*[rate(weighed, j, 1) for j in range(len(RULES))]).alias("good"),
                        F.array(*[rate(weighed, j, 0) for j in range(len(RULES))]).alias("bad"))

    def one_round(state: Column, _: Column) -> Column:
        weighed = F.transform("found", lambda p: F.struct(p["v"].alias("v"), p["n"].alias("n"), posterior(p, state).alias("q")))
        return F.get(F.transform(F.array(weighed), maximise), F.lit(0))

    start = F.struct(F.lit(START_PRIOR).alias("prior"), F.array(*[F.lit(START_GOOD)] * len(RULES)).alias("good"),
                     F.array(*[F.lit(START_BAD)] * len(RULES)).alias("bad"))
    rounds = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one_round)
    return table.select(rounds.alias("state")).select("state.prior", "state.good", "state.bad")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, quality (posterior) and kept for every row of ``docs``.

    A null text counts as empty and fails the base rules; so does any text of fewer
    than 50 words.  Repeated rows are judged each; an empty table gives no rows.
    """
    voted = scratch.stored(votes(counted(docs)), "votes")
    fitted = estimate(voted).first()  # 1 + 2 * rules numbers
    good, bad = F.lit(fitted.prior), F.lit(1 - fitted.prior)
    for (name, *_), on_good, on_bad in zip(RULES, fitted.good, fitted.bad):
        v = F.col(f"v_{name}")
        good = good * F.when(v == 1, on_good).when(v == 0, 1 - on_good).otherwise(1.0)
        bad = bad * F.when(v == 0, on_bad).when(v == 1, 1 - on_bad).otherwise(1.0)
    return (voted.withColumn("quality", good / (good + bad)).withColumn("base_failed", F.expr(BASE_FAILED))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_AT)))


def oracle_sql() -> str:
    """The same in DuckDB SQL over ``documents``: EM as a recursive query over the vote patterns."""
    r = range(len(RULES))
    case = ", ".join(f"CASE WHEN n_words = 0 THEN -1 WHEN {bad} THEN 0 WHEN {good} THEN 1 ELSE -1 END AS v{j}" for j, (_, bad, good) in enumerate(RULES))
    vs = ", ".join(f"v{j}" for j in r)
    good = "prior" + "".join(f" * CASE v{j} WHEN 1 THEN g{j} WHEN 0 THEN 1 - g{j} ELSE 1.0 END" for j in r)
    bad = "(1 - prior)" + "".join(f" * CASE v{j} WHEN 0 THEN b{j} WHEN 1 THEN 1 - b{j} ELSE 1.0 END" for j in r)
    rate = lambda j, side, q: f"(sum(CASE WHEN v{j} = {side} THEN n * {q} ELSE 0.0 END) + 1) / (sum(CASE WHEN v{j} >= 0 THEN n * {q} ELSE 0.0 END) + 2)"
    step = ", ".join([rate(j, 1, "q") for j in r] + [rate(j, 0, "(1 - q)") for j in r])
    names = ", ".join([f"g{j}" for j in r] + [f"b{j}" for j in r])
    start = ", ".join([f"{START_GOOD}::DOUBLE AS g{j}" for j in r] + [f"{START_BAD}::DOUBLE AS b{j}" for j in r])
    stop = ", ".join(f"'{w}'" for w in FUNCTION_WORDS)
    return rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
         list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '{WORD}')) AS lines
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
places AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM places) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
counts AS (
  SELECT t.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines, (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
         (length(text) - length(replace(text, '!', '')))::BIGINT AS n_exclaim, len(list_distinct(words))::BIGINT AS n_distinct,
         len(list_filter(words, lambda w: regexp_matches(w, '{MARKED}')))::BIGINT AS n_marked,
         len(list_filter(words, lambda w: w IN ({stop})))::BIGINT AS n_function
  FROM texts t LEFT JOIN covered c ON t.doc_id = c.doc_id),
voted AS (SELECT *, {case} FROM counts),
patterns AS (SELECT {vs}, count(*)::DOUBLE AS n FROM voted GROUP BY {vs}),
em AS (
  SELECT 0 AS round, {START_PRIOR}::DOUBLE AS prior, {start}
  UNION ALL
  SELECT any_value(round) + 1, (sum(n * q) + 1) / (sum(n) + 2), {step}
  FROM (SELECT p.*, round, ({good}) / ({good} + {bad}) AS q FROM patterns p, em WHERE round < {ROUNDS})
  HAVING count(*) > 0),
final AS (SELECT prior, {names} FROM em WHERE round = {ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({BASE_FAILED}) AS base_failed,
       NOT ({BASE_FAILED}) AND ({good}) / ({good} + {bad}) >= {KEEP_AT} AS kept
FROM voted, final
"""
