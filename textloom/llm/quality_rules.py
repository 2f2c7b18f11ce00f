"""Quality rules by weak supervision, in Spark SQL functions only.

Every document gets base counts, each rule votes on the counts (good 1 or bad -1) or abstains (0), and expectation-maximisation over the vote patterns of the whole table estimates how
often each rule votes in each class. A document's posterior probability of being good replaces
"all rules must pass".

The votes are aggregated to patterns first: there are at most ``2 ** len(RULES)`` of them however
large the table, so the iterations run inside one row as a higher-order ``aggregate`` over that
bounded array and no document is read twice: the counts are written once as a narrow table.

Edge cases: null and empty texts have no words and fail the base rules; ties cannot occur (the
verdict is a threshold); repeated rows are judged one by one, each alike; an empty table gives an
empty result (parameters fall back to their priors); a null id is carried along; other columns
are ignored by ``score_quality`` and kept by ``filter_quality``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import keep_ids, materialize, row_hash

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ITERATIONS = 25
PRIOR_GOOD = 0.85
THRESHOLD = 0.5
#: Weight, in documents, of the prior belief about how often a rule votes in its own class and in
#: the other. A rule is taken to be ``SPECIFIC`` times as likely to vote in its own class at
#: least, which keeps the two classes of the estimate from trading places or following length.
PRIOR_WEIGHT = 20.0
PRIOR_OWN = {-1: 0.2, 1: 0.8}
SPECIFIC = {-1: 50.0, 1: 1.2}

#: name, vote (good 1, bad -1), when (over the base counts); otherwise the rule abstains.
RULES: list[tuple[str, int, str]] = [
    ("symbols", -1, "100 * n_symbols > 4 * word_chars"),
    ("dup_lines", -1, "10 * n_dup_lines > 3 * n_lines"),
    ("repeats", -1, "100 * n_repeat_words > 35 * n_words"),
    ("capitals", -1, "100 * n_capitals > 40 * word_chars"),
    ("word_size", -1, "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    ("no_stops", -1, "n_stops = 0 AND n_words >= 100"),
    ("length", 1, "n_words >= 80"),
    ("stops", 1, "100 * n_stops >= n_words"),
]


def words_of(text: Column) -> Column:
    """Words between runs of ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def _with_repeat_words(df: DataFrame, width: int = 3, hash_bits: int = 64) -> DataFrame:
    """Adds ``n_repeat_words``: words inside a window of ``width`` that occurs at least twice.

    A window's hash is packed above its position into one long, so that a primitive sort brings
    equal windows together; neighbours are then compared word by word, so a hash collision
    cannot count. As it might stand between two equal windows, a text with one is done again by its words. Each array is a column of its own: a lambda that named an expression instead
    would evaluate it again for every element.
    """
    df = df.withColumn("_bits", F.ceil(F.log2(F.size("_words") + 2)).cast("int")).withColumn("_mask", F.expr("shiftleft(1L, _bits) - 1"))
    # Fewer ``hash_bits`` make collisions likely (in tests).
    name = lambda i: F.call_function("shiftrightunsigned", F.xxhash64(*[F.get("_hashes", i + k) for k in range(width)]), F.lit(64 - hash_bits))
    packed = F.transform(
        F.sequence(F.lit(0), F.size("_words") - width),
        lambda i: F.call_function("shiftleft", name(i), F.col("_bits")).bitwiseOR(i.cast("long")),
    )
    df = df.withColumn("_ordered", F.when(F.size("_words") > width, F.sort_array(packed)).otherwise(F.expr("CAST(array() AS ARRAY<BIGINT>)")))
    key = lambda x: F.call_function("shiftright", x, F.col("_bits"))
    at = lambda x: F.slice("_words", x.bitwiseAND(F.col("_mask")).cast("int") + 1, width)
    # The slices are compared only where the keys agree: 1 equal, 2 a collision of keys.
    same = lambda a, b: F.when(key(a) == key(b), F.when(at(a) == at(b), 1).otherwise(2)).otherwise(0)
    before = lambda x, i: F.when(i > 0, same(x, F.get("_ordered", i - 1))).otherwise(0)
    after = lambda x, i: F.coalesce(same(x, F.get("_ordered", i + 1)), F.lit(0))
    judge = lambda x, p, n: F.when((p == 1) | (n == 1), x.bitwiseAND(F.col("_mask"))).when((p == 2) | (n == 2), F.lit(-1).cast("long"))
    df = df.withColumn("_found", F.array_compact(F.transform("_ordered", lambda x, i: judge(x, before(x, i), after(x, i)))))
    # Where keys collided, windows are sorted by their words.
    exact = F.array_sort(F.transform(F.sequence(F.lit(0), F.size("_words") - width), lambda i: F.struct(F.slice("_words", i + 1, width).alias("w"), i.cast("long").alias("i"))))
    df = df.withColumn("_exact", F.when(F.array_contains("_found", -1), exact))
    twice = lambda x, i: (F.when(i > 0, x["w"] == F.get("_exact", i - 1)["w"]).otherwise(False)) | F.coalesce(x["w"] == F.get("_exact", i + 1)["w"], F.lit(False))
    surely = F.transform(F.filter("_exact", twice), lambda x: x["i"])
    df = df.withColumn("_marked", F.sort_array(F.when(F.col("_exact").isNotNull(), surely).otherwise(F.col("_found"))))
    state = F.struct(F.lit(-width).cast("long").alias("last"), F.lit(0).cast("long").alias("covered"))
    step = lambda s, p: F.struct(p.alias("last"), (s["covered"] + F.least(F.lit(width).cast("long"), p - s["last"])).alias("covered"))
    return df.withColumn("n_repeat_words", F.aggregate("_marked", state, step, lambda s: s["covered"]))


#: Frequent function words of the corpus languages (fixed values).
STOPS = ["the", "of", "and", "to", "in", "is", "la", "le", "de", "les", "et", "que", "der", "die", "und", "den", "el", "en", "y", "los"]


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the base counts to ``docs`` in one pass over the texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_replace(x, SPACE, "") != "")
    out = docs.withColumn("_words", words_of(text)).withColumn("n_words", F.size("_words").cast("long"))
    out = out.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w))).withColumn("_lines", lines)
    out = _with_repeat_words(out.withColumn("_joined", F.array_join("_words", "")))
    without = lambda pattern: (F.length("_joined") - F.length(F.regexp_replace("_joined", pattern, ""))).cast("long")
    return out.select(
        *docs.columns,
        "n_words",
        F.length("_joined").cast("long").alias("word_chars"),
        without(SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_lines").cast("long").alias("n_lines"),
        without(r"\p{Lu}").alias("n_capitals"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(STOPS))).cast("long").alias("n_stops"),
    )


def votes() -> Column:
    """The rules' votes on one row of base counts, as an array of tinyint."""
    return F.array(*[F.expr(f"CAST(CASE WHEN {when} THEN {vote} ELSE 0 END AS TINYINT)") for _, vote, when in RULES])


def _log_odds(vote_array: str, params: str) -> str:
    """SQL: log odds of "good" for an array of votes; ``good[k]`` and ``bad[k]`` are the chances
    that rule k votes in a good and in a bad document, so abstaining is evidence too."""
    return (
        f"ln({params}.prior / (1 - {params}.prior)) + aggregate(zip_with({vote_array}, zip_with({params}.good, {params}.bad, (g, b) -> struct(g, b)), "
        "(v, p) -> CASE WHEN v <> 0 THEN ln(p.g / p.b) ELSE ln((1 - p.g) / (1 - p.b)) END), 0D, (s, x) -> s + x)"
    )


def estimate(voted: DataFrame, rules: list[tuple[str, int, str]] = RULES) -> DataFrame:
    """One row ``params``: prior and how often each rule votes in each class, by EM over the vote patterns of ``voted``."""
    k = len(rules)
    patterns = voted.groupBy("votes").agg(F.count(F.lit(1)).cast("double").alias("n"))
    # At most 2 ** k patterns: a bounded array whatever the number of documents.
    one = patterns.agg(F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    doubles = lambda values: f"array({', '.join(f'{v}D' for v in values)})"
    own = [PRIOR_OWN[v] for _, v, _ in rules]
    other = [PRIOR_OWN[v] / SPECIFIC[v] for _, v, _ in rules]
    good = [o if v > 0 else x for (_, v, _), o, x in zip(rules, own, other, strict=True)]
    bad = [o if v < 0 else x for (_, v, _), o, x in zip(rules, own, other, strict=True)]
    start = f"named_struct('prior', {PRIOR_GOOD}D, 'good', {doubles(good)}, 'bad', {doubles(bad)})"
    # E step: q is the posterior of each pattern. M step: weighted shares, with the prior's weight.
    share = lambda weight, prior: f"transform({doubles(prior)}, (b, r) -> (b * {PRIOR_WEIGHT}D + aggregate(e, 0D, (s, x) -> s + CASE WHEN x.votes[r] <> 0 THEN {weight} ELSE 0D END)) / ({PRIOR_WEIGHT}D + aggregate(e, 0D, (s, x) -> s + {weight})))"
    most = lambda mine, theirs, sign: f"zip_with({mine}, zip_with({theirs}, {doubles([1 / SPECIFIC[v] if v == sign else 1e9 for _, v, _ in rules])}, (t, f) -> t * f), (m, c) -> least(0.999D, greatest(1e-6D, least(m, c))))"
    # Let-bindings: transform over a one-element array names an intermediate result.
    e_step = "transform(patterns, x -> named_struct('votes', x.votes, 'n', x.n, 'q', 1 / (1 + exp(-(" + _log_odds("x.votes", "p") + ")))))"
    m_step = (
        f"named_struct('prior', least(0.99D, greatest(0.01D, ({PRIOR_GOOD}D * {PRIOR_WEIGHT}D + aggregate(e, 0D, (s, x) -> s + x.q * x.n)) / ({PRIOR_WEIGHT}D + aggregate(e, 0D, (s, x) -> s + x.n)))), "
        f"'good', {share('x.q * x.n', good)}, 'bad', {share('(1 - x.q) * x.n', bad)})"
    )
    held = f"named_struct('prior', u.prior, 'good', {most('u.good', 'u.bad', -1)}, 'bad', {most('u.bad', 'u.good', 1)})"
    step = f"element_at(transform(transform(array({e_step}), e -> {m_step}), u -> {held}), 1)"
    return one.select(F.expr(f"aggregate(sequence(1, {ITERATIONS}), {start}, (p, i) -> {step})").alias("params"))


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, base counts, ``base_failed, votes, p_good, kept`` for every row of ``docs``."""
    narrow = docs.select(F.col(id_col), *keep, F.col(text_col).alias("_text"))
    counted = base_counts(narrow, "_text").drop("_text").withColumn("votes", votes())
    failed = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    counted = materialize(counted.withColumn("base_failed", failed), "quality-counts")
    # One row of fixed width: broadcasting it is bounded.
    scored = counted.join(F.broadcast(estimate(counted)), how="inner")
    posterior = scored.withColumn("p_good", F.expr(f"1 / (1 + exp(-({_log_odds('votes', 'params')})))")).drop("params")
    return posterior.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= THRESHOLD))


def filter_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only."""
    keyed = docs.select(id_col, text_col, row_hash(text_col).alias("row"))
    out = score_quality(keyed, id_col, text_col, keep=("row",)).where("NOT kept").select(F.col(id_col).alias("_rejected"), "row").distinct()
    return keep_ids(docs, materialize(out, "quality-rejected"), id_col, anti=True, ids_col="_rejected", row=row_hash(text_col))
