"""Quality rules by weak supervision.

Every rule looks at a few counts of a document and votes good, votes bad or
abstains. Nobody says how far a rule is to be trusted: expectation-maximisation
estimates, from the agreement of the votes over all documents, each rule's
accuracy among its good votes and among its bad votes, and the share of good
documents. A document's verdict is its posterior probability of being good.

Everything a row needs is computed by Spark expressions on the row; rows of the
same votes are counted (at most 3^rules patterns, whatever the table's size), and
the iterations run over these counts. The posteriors come back as a lookup by
vote pattern.

Definitions. Words are runs of characters other than space and \\t..\\r. Base
counts: ``word_chars`` code points in words; ``n_symbols`` characters of
``#*$%&|<>``; ``n_dup_lines`` lines with a word that equal an earlier line;
``n_repeat_words`` words lying in a 3-word window that occurs at least twice in
the text. Windows are looked up by the high bits of a 64-bit hash packed with the
position into one sorted array of longs; candidates are then compared as words.

Defined results: null text is empty; an empty text has no words, fails the base
rule and gets posterior 0; repeated rows get the same verdict each; an empty table
gives no rows. All input columns can be kept (``label_quality``); the operator's
own column replaces an input column of the same name only in ``judge_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, reliable_checkpoint, text_or_empty

SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_POSTERIOR = 0.5

#: EM: iterations, and pseudo-votes (right, wrong) that each rule starts from.
ITERATIONS = 25
PRIOR_VOTES = (16.0, 4.0)
PRIOR_GOOD = (8.0, 2.0)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def _repeat_words(w: Column) -> Column:
    """Words of ``w`` in 3-word windows that occur twice or more."""
    n = F.size(w)

    def at(i: Column, k: int) -> Column:
        return F.get(w, i.cast("int") + k)

    def cover(starts: Column) -> Column:
        step = F.transform(starts, lambda p, i: F.when(
            i + 1 < F.size(starts), F.least(F.lit(3), F.get(starts, i + 1) - p)).otherwise(F.lit(3)))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    def neighbours(a: Column, key) -> Column:
        return F.filter(a, lambda x, i: (
            ((i > 0) & (key(F.get(a, i - 1)) == key(x)))
            | ((i + 1 < F.size(a)) & (key(F.get(a, i + 1)) == key(x)))))

    def windows(bits: Column) -> Column:
        high = F.call_function("shiftleft", F.lit(-1).cast("long"), bits)
        low = F.bitwise_not(high)
        packed = F.sort_array(F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2)).bitwiseAND(high).bitwiseOR(i.cast("long"))))
        likely = _let(packed, lambda a: neighbours(a, lambda x: x.bitwiseAND(high)))
        exact = F.sort_array(F.transform(likely, lambda x: _let(x.bitwiseAND(low), lambda i: F.struct(
            F.concat_ws(" ", at(i, 0), at(i, 1), at(i, 2)).alias("k"), i.alias("p")))))
        same = _let(exact, lambda a: F.transform(neighbours(a, lambda x: x["k"]), lambda x: x["p"]))
        return _let(F.sort_array(same), cover)

    bits = (F.floor(F.log2(F.greatest(n, F.lit(1)))) + 1).cast("int")
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(_let(bits, windows))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(
        F.translate(x, SPACES, " " * len(SPACES))) != "")
    return _let(lines, lambda a: F.struct(
        F.size(a).cast("long").alias("lines"),
        (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("dup")))


def measured(text: Column) -> Column:
    """Struct of all counts of one text."""
    bare = F.translate(text, " " + SPACES, "")
    words = _let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), _repeat_words(w).alias("rep")))
    return F.struct(
        words.alias("w"), F.length(bare).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _dup_lines(text).alias("l"),
        F.regexp_count(text, F.lit(r"[A-Z]")).cast("long").alias("upper"),
        F.regexp_count(text, F.lit(r"\p{L}")).cast("long").alias("letters"),
        F.regexp_count(text, F.lit(r"!!|\?\?")).cast("long").alias("shouts"),
        F.regexp_count(text, F.lit(r"\p{L}[.!?]?(?=[ \t-\r]|$)")).cast("long").alias("plain_ends"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(0)).when(good, F.lit(2)).otherwise(F.lit(1))


def rule_votes(m: Column) -> dict[str, Column]:
    """0 bad, 1 abstain, 2 good, of every rule, from :func:`measured`."""
    n = F.greatest(m["w"]["n"], F.lit(1))
    lines = F.greatest(m["l"]["lines"], F.lit(1))
    chars = F.greatest(m["word_chars"], F.lit(1))
    letters = F.greatest(m["letters"], F.lit(1))
    return {
        "symbols": _vote(m["n_symbols"] * 10 > n, m["n_symbols"] * 50 <= n),
        "symbol_share": _vote(m["n_symbols"] * 25 > chars, m["n_symbols"] * 200 <= chars),
        "repeats": _vote(m["w"]["rep"] * 100 > n * 25, m["w"]["rep"] * 100 <= n * 5),
        "dup_lines": _vote(m["l"]["dup"] * 100 > lines * 30, m["l"]["dup"] * 100 <= lines * 5),
        "upper": _vote(m["upper"] * 100 > letters * 35, m["upper"] * 100 <= letters * 15),
        "shouts": _vote(m["shouts"] * 20 > n, m["shouts"] * 100 <= n),
        "letters": _vote(m["letters"] * 100 < chars * 75, m["letters"] * 100 >= chars * 90),
        "word_ends": _vote(m["plain_ends"] * 100 < n * 60, m["plain_ends"] * 100 >= n * 80),
        "length": _vote(F.lit(False), m["w"]["n"] >= 2 * MIN_WORDS),
    }


RULES = ("symbols", "symbol_share", "repeats", "dup_lines", "upper", "shouts", "letters",
         "word_ends", "length")


def estimate(patterns: dict[tuple[int, ...], int]) -> tuple[float, list[tuple[float, float]]]:
    """EM over counted vote patterns: the share of good documents, and each
    rule's (P(right | it votes, document good), P(right | it votes, document bad)).
    The pseudo-votes keep a rule at least as good as a coin, so that good stays
    the side that the good votes are on."""
    rules = len(next(iter(patterns), ()))
    right, wrong = PRIOR_VOTES
    good = PRIOR_GOOD[0] / sum(PRIOR_GOOD)
    trust = [(right / (right + wrong),) * 2 for _ in range(rules)]
    for _ in range(ITERATIONS):
        mass = list(PRIOR_GOOD)
        hit = [[right, right] for _ in range(rules)]
        cast = [[right + wrong, right + wrong] for _ in range(rules)]
        for votes, count in patterns.items():
            p = posterior(votes, good, trust)
            mass[0] += count * p
            mass[1] += count * (1 - p)
            for j, v in enumerate(votes):
                if v != 1:
                    cast[j][0] += count * p
                    cast[j][1] += count * (1 - p)
                    hit[j][v == 0] += count * (p if v == 2 else 1 - p)
        good = mass[0] / sum(mass)
        trust = [tuple(min(0.995, max(0.5, hit[j][k] / cast[j][k])) for k in (0, 1))
                 for j in range(rules)]
    return good, trust


def posterior(votes, good: float, trust) -> float:
    """P(good | votes) under conditionally independent rules."""
    odds = math.log(good / (1 - good))
    for v, (g, b) in zip(votes, trust):
        if v == 2:
            odds += math.log(g / (1 - b))
        elif v == 0:
            odds += math.log((1 - g) / b)
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def judge_documents(docs: DataFrame, text_col: str = "text", payload: list[str] | None = None,
                    name: str = "judged") -> DataFrame:
    """``payload`` columns and a struct ``name``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, votes, posterior, kept. An input column
    called ``name`` gives way to it. Texts are measured once: the rows are stored with
    their counts before the patterns are read and again when the verdicts come back."""
    spark = docs.sparkSession
    payload = [c for c in (docs.columns if payload is None else payload) if c != name]
    mark = "_m_" + "_".join(docs.columns)  # no input column can have this name
    rows = docs.select(*[F.col(f"`{c}`") for c in payload],
                       measured(text_or_empty(F.col(f"`{text_col}`"))).alias(mark))
    m = F.col(mark)
    n, rep = m["w"]["n"], m["w"]["rep"]
    failed = (n < MIN_WORDS) | (rep * 100 > n * MAX_REPEAT_PERCENT)
    votes = rule_votes(m)
    code = F.lit(0)
    for rule in RULES:
        code = code * 3 + votes[rule]
    rows = reliable_checkpoint(rows)
    patterns = {}
    for r in rows.groupBy(code.alias("c")).count().collect():  # at most 3^9 rows
        digits, c = [], r["c"]
        for _ in RULES:
            digits.append(c % 3)
            c //= 3
        patterns[tuple(reversed(digits))] = r["count"]
    good, trust = estimate(patterns)
    table = [(sum(v * 3 ** (len(RULES) - 1 - j) for j, v in enumerate(p)), posterior(p, good, trust))
             for p in patterns]
    seen = spark.createDataFrame(table or [(-1, 0.0)], "code int, posterior double").select(
        F.col("code").alias("_seen" + mark), F.col("posterior").alias("_posterior" + mark))
    joined = rows.withColumn("_code" + mark, code).join(
        F.broadcast(seen), F.col("_code" + mark) == F.col("_seen" + mark), "left")
    post = F.when(n == 0, F.lit(0.0)).otherwise(F.coalesce("_posterior" + mark, F.lit(0.0)))
    return joined.select(*[F.col(f"`{c}`") for c in payload], F.struct(
        n.alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["l"]["dup"].alias("n_dup_lines"), rep.alias("n_repeat_words"),
        failed.alias("base_failed"), F.struct(*[votes[x].alias(x) for x in RULES]).alias("votes"),
        post.alias("posterior"), (~failed & (post >= KEEP_POSTERIOR)).alias("kept")).alias(name))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    name = "_judged_" + "_".join(docs.columns)
    return (judge_documents(docs, text_col, name=name).filter(F.col(name)["kept"])
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = judge_documents(read_table(spark, sf_dir, "documents"), payload=["doc_id"])
    return out.select("doc_id", *[f"judged.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "posterior")])
