"""Language identification by Bayesian fusion of text, markup, address and host.

Text likelihoods come from hashed three-byte grams of every whole text, under a
multinomial model fitted on a bounded sample of rows with a declared language
(``sample_rows`` a language, chosen by hash). A long text's grams repeat each
other, so its log-likelihood counts as ``most_grams`` independent grams at
most. Every row's best language by text alone is its vote. Grouped aggregation
of the votes gives how often a language goes with a declared one and with an
address suffix, and the priors of hosts: a host's votes are smoothed by its
parent domain's prior, that by its parent's, up to the whole corpus. A row's
own vote is left out of its own priors. The fused posterior decides.

Beside the languages there is one more hypothesis, that the text is in none of
them: all grams of a 26-letter alphabet and a blank are then equally likely,
and ``other`` is its prior. Gibberish and texts in languages that are not
modelled are rejected by it. Modelled are the languages that ``least_rows``
rows or more declare, and of those the ``most_languages`` most frequent, which
bounds the model that every task holds.

Defined results: a text without a letter (null, empty, digits only) is
rejected, with no language; null declared languages, suffixes and hosts are no
evidence; a row whose best posterior is under ``least`` is rejected. Repeated
rows get equal results. Without any declared language nothing can be learned
and every row is rejected. Ties go to the first language in alphabetic order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import by_size, per_batch, quoted, staged, text_of

BUCKETS = 1 << 16
FLAT = -3 * np.log(27)  # of a gram, where any is as likely
#: A table of votes up to this many bytes goes to every task; larger ones are joined by shuffle.
_SMALL = 32 << 20
_SALTS = 64
SCORES = "row_key long, n_grams long, loglik array<double>, declared string, suffix string, host string"
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = [c if chr(c).isalpha() else 32 for c in range(128)]


def grams(text: bytes) -> np.ndarray:
    """Buckets of all three-byte grams with a letter in the middle; A-Z and a-z count as equal."""
    b = _FOLD[np.frombuffer(b" " + text.lower() + b" ", np.uint8)]
    b = b[np.concatenate(([True], (b[1:] != 32) | (b[:-1] != 32)))]
    code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    code = code[b[1:-1] != 32]
    return (code * np.uint32(2654435761)) >> np.uint32(16)


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def languages_of(rows: DataFrame, least_rows: int, most: int) -> dict[str, int]:
    """Declared languages with enough rows, and their rows: ``most`` at most."""
    counts = rows.filter("declared is not null").groupBy("declared").count().filter(F.col("count") >= least_rows)
    return {r.declared: r["count"] for r in counts.orderBy(F.desc("count"), "declared").limit(most).collect()}


def fit(rows: DataFrame, languages: dict[str, int], sample_rows: int) -> np.ndarray:
    """Log-probabilities of the buckets for each language, from a sample by hash."""
    names = sorted(languages)
    share = F.element_at(F.create_map(*(F.lit(x) for n in names for x in (n, min(1.0, sample_rows / languages[n])))), F.col("declared"))
    chosen = rows.filter(F.col("declared").isin(names)).filter(F.pmod(F.xxhash64("row_key"), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros((len(names), BUCKETS), np.int64)
        for batch in batches:
            for name, text in zip(batch.column("declared").to_pylist(), batch.column("text"), strict=True):
                total[names.index(name)] += np.bincount(grams(text.as_py()), minlength=BUCKETS)
        which, bucket = np.nonzero(total)
        yield {"which": which, "bucket": bucket, "n": total[which, bucket]}

    counted = per_batch(chosen.select("declared", "text"), "which int, bucket int, n long", count)
    table = np.zeros((BUCKETS, len(names)))
    for r in counted.groupBy("which", "bucket").agg(F.sum("n").alias("n")).collect():  # languages x buckets at most
        table[r.bucket, r.which] = r.n
    return np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32)


def _score(model: np.ndarray):
    width = model.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for rows in by_size(batch, "text", 8 << 20):
                found, sums = [], []
                for text in rows["text"]:
                    g = grams(text) if _has_letter(text) else np.zeros(0, np.uint32)
                    found.append(len(g))
                    total = np.zeros(width)
                    for i in range(0, len(g), 1 << 18):
                        total += model[g[i : i + (1 << 18)]].sum(axis=0, dtype=np.float64)
                    sums.append(total.tolist())
                yield {c: rows[c] for c in ("row_key", "declared", "suffix", "host")} | {"n_grams": found, "loglik": sums}

    return work


def _votes(n: int) -> Column:
    return F.array(*(F.count(F.when(F.col("vote") == i, 1)).cast("double") for i in range(n)))


def _without_own(votes: Column, vote: Column) -> Column:
    return F.transform(votes, lambda v, i: v - F.when(vote == i, 1.0).otherwise(0.0))


def _smoothed(votes: Column, prior: Column, weight: float) -> Column:
    total = F.aggregate(votes, F.lit(0.0), lambda a, v: a + v)
    return F.zip_with(votes, prior, lambda v, p: (v + weight * p) / (total + weight))


def _with_votes(out: DataFrame, voted: DataFrame, kind: str, n: int) -> DataFrame:
    """Adds the votes of each row's ``kind``, null where it has none.

    A small table goes to every task. In the join of a large one, rows of a
    frequent name, and those of none, are spread over many tasks by a salt.
    """
    counted = voted.filter(F.col(kind).isNotNull()).groupBy(kind).agg(_votes(n).alias(f"{kind}_votes"), F.count("*").alias("n_rows"))
    counted = staged(counted, f"votes-{kind}")
    amount = counted.agg(F.count("*").alias("names"), F.sum("n_rows").alias("n_rows")).first()
    if amount["names"] * (8 * n + 64) <= _SMALL:
        return out.join(F.broadcast(counted.drop("n_rows")), kind, "left")
    often = F.col("n_rows") > amount["n_rows"] / 10_000  # of fewer than 10,000 names
    salts = F.when(often, F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = counted.withColumn("salt", F.explode(salts)).drop("n_rows")
    hot = counted.filter(often).select(kind, F.lit(True).alias("often"))
    salt = F.when(F.coalesce("often", F.col(kind).isNull()), F.pmod(F.xxhash64("row_key", "loglik"), F.lit(_SALTS))).otherwise(0)
    salted = out.join(F.broadcast(hot), kind, "left").withColumn("salt", salt.cast("int")).drop("often")
    return salted.join(spread, [kind, "salt"], "left").drop("salt")


def identify(
    rows: DataFrame, sample_rows: int = 2000, least_rows: int = 20, most_grams: int = 200, least: float = 0.5, weight: float = 10.0,
    other: float = 0.01, most_languages: int = 256,
) -> DataFrame:
    """(row_key, declared, lang, confidence, n_grams, kept) of rows (row_key, text, declared, suffix, host)."""
    rows = rows.withColumn("text", F.coalesce("text", F.lit(b"")))
    languages = languages_of(rows, least_rows, most_languages)
    names = sorted(languages)
    if not names:
        return rows.select("row_key", "declared", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
                           F.lit(0).cast("long").alias("n_grams"), F.lit(False).alias("kept"))
    n = len(names)
    model = fit(rows, languages, sample_rows)
    scores = staged(per_batch(rows.select("row_key", "text", "declared", "suffix", "host"), SCORES, _score(model)), "scores")
    tempered = F.transform("loglik", lambda x: x * F.least(F.lit(1.0), most_grams / F.greatest(F.col("n_grams"), F.lit(1))))
    best = F.array_position("loglik", F.array_max("loglik")).cast("int") - 1
    voted = scores.withColumns({
        "vote": F.when(F.col("n_grams") > 0, best), "tempered": tempered,
        "domain": F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), "top": F.regexp_extract("host", r"([^.]+)$", 1),
    })
    for level, below in (("domain", "host"), ("top", "domain")):  # a name that is its own parent is no level of its own
        voted = voted.withColumn(level, F.when((F.col(level) != "") & (F.col(level) != F.col("host")) & (F.col(level) != F.coalesce(F.col(below), F.lit(""))), F.col(level)))
    totals = voted.agg(_votes(n).alias("v")).first().v
    everyone = F.array(*(F.lit((v + 1.0) / (sum(totals) + n)) for v in totals))
    out = voted
    for kind in ("declared", "suffix", "host", "domain", "top"):
        out = _with_votes(out, voted, kind, n)
    none = F.array(*(F.lit(0.0) for _ in names))
    own = {k: _without_own(F.coalesce(f"{k}_votes", none), F.when(F.col(k).isNotNull(), F.col("vote"))) for k in ("declared", "suffix", "host", "domain", "top")}
    out = out.withColumns({k: v for k, v in ((f"{k}_votes", own[k]) for k in own)})
    out = out.withColumn("prior", _smoothed(F.col("top_votes"), everyone, weight))
    out = out.withColumn("prior", _smoothed(F.col("domain_votes"), F.col("prior"), weight))
    out = out.withColumn("prior", _smoothed(F.col("host_votes"), F.col("prior"), weight))
    # How much likelier the clue is with a language than at large: its smoothed share over the corpus share.
    out = out.withColumn("log_p", F.zip_with("prior", "tempered", lambda p, t: F.ln(p) + t))
    for clue in ("declared", "suffix"):
        ratio = F.zip_with(_smoothed(F.col(f"{clue}_votes"), everyone, weight), everyone, lambda s, e: F.ln(s / e))
        out = out.withColumn("log_p", F.zip_with("log_p", ratio, lambda a, b: a + b))
    none_of_them = F.lit(float(np.log(other))) + float(FLAT) * F.least(F.col("n_grams"), F.lit(most_grams))
    # Of the best language against all others and against none; beyond 700 an exponential overflows.
    out = out.withColumn("top_p", F.array_max("log_p")).withColumn(
        "confidence", 1.0 / (
            F.aggregate("log_p", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top_p")))
            + F.exp(F.least(F.lit(700.0), none_of_them - F.col("top_p")))
        )
    )
    sure = (F.col("n_grams") > 0) & (F.col("confidence") >= least)
    lang = F.element_at(F.array(*map(F.lit, names)), F.array_position("log_p", F.col("top_p")).cast("int"))
    return out.select(
        "row_key", "declared", F.when(sure, lang).alias("lang"), F.when(F.col("n_grams") > 0, F.col("confidence")).otherwise(0.0).alias("confidence"),
        "n_grams", sure.alias("kept"),
    )


def evidence_of_documents(docs: DataFrame, key: Column) -> DataFrame:
    """Documents as evidence: the declared language, and the source as host."""
    return docs.select(
        key.alias("row_key"), text_of("text").cast("binary").alias("text"),
        F.nullif(F.lower("lang"), F.lit("")).alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.nullif(F.col("source").cast("string"), F.lit("")).alias("host"),
    )


def evidence_of_pages(pages: DataFrame) -> DataFrame:
    """Web pages as evidence: visible text, the markup's ``lang``, suffix and host of the address.

    The suffix is the first part of the path where that is a two-letter code,
    else the last label of the host.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    seen = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style|nav|footer)\b.*?</\1\s*>|<!--.*?-->", " "), "<[^>]*>", " ")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://([^/:?#]+)", 1))
    code = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://[^/]+/([a-z]{2})(?:/|$)", 1)
    declared = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return pages.select(
        F.col("page_id").cast("long").alias("row_key"), seen.cast("binary").alias("text"), F.nullif(declared, F.lit("")).alias("declared"),
        F.nullif(F.when(code != "", code).otherwise(F.regexp_extract(host, r"([^.]+)$", 1)), F.lit("")).alias("suffix"),
        F.nullif(host, F.lit("")).alias("host"),
    )


def keep_identified(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows whose language is clear, with all columns; ``lang`` is the language found.

    Rows without an id are judged alike: the key is the id and the text's hash.
    """
    key = F.xxhash64(quoted(id_col), text_of("text"), "lang", "source")
    found = identify(evidence_of_documents(docs, key)).filter("kept").select(F.col("row_key").alias("found_key"), F.col("lang").alias("found_lang")).dropDuplicates(["found_key"])
    whole = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"), key.alias("own_key"))
    done = whole.join(found, F.col("own_key") == F.col("found_key"))
    return done.select(*((F.col("found_lang") if c == "lang" else F.col(f"row.{quoted(c)}")).alias(c) for c in docs.columns))
