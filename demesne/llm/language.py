"""Language identification by Bayesian evidence fusion (operator 9).

Four kinds of evidence are added as log likelihoods for each language and for `und` (none of them):

* the text: naive Bayes over hashed words, their beginnings and endings. The tables come from the
  rows that declare a language, `LOT` languages a pass and one fixed array a task, so that every
  language declared is learned; a text counts for at most
  `TEXT_CAP` of its average word, as words of one text are not independent;
* the language declared in the markup (or in a column), wrong with a small probability; of a tag
  with a region or script the language counts (en-US, en_gb: en);
* the suffix of the address, where it is a country's;
* the host: its share of languages among the texts of the host, smoothed by that of its domain,
  smoothed by that of the suffix, smoothed by that of all rows. The shares are grouped sums of text
  posteriors, so a host with a third of all rows costs one row a task.

Rows travel as two numbers for each language; texts are never shuffled. A row is accepted if the best language
is not `und` and its posterior reaches `least`.

Defined results: null is the empty text; a row without words has no language (`und`, not accepted),
whatever it declares; a null host, suffix or declaration is no evidence; repeated rows are judged
each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.llm.common import dense_counts, lower, per_piece, raw, span_hashes, words
from demesne.session import cut

TERMS, ALPHA = 1 << 16, 0.5
#: Languages whose terms are counted in one pass, and weighed at a time.
LOT = 32
#: Words of evidence that one text counts for at most; the share of wrong declarations; the weight of each level of the host prior.
TEXT_CAP, WRONG, STRENGTH = 30.0, 0.05, 8.0
LEAST = 0.6
# Languages of country suffixes.
COUNTRY = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "uk": "en", "us": "en", "au": "en", "ie": "en", "pl": "pl", "se": "sv"}

_BREAK = np.ones(256, bool)
_BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False


def terms(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of all texts, three a word, and the number of words of each text."""
    data, offsets = raw(col)
    data = lower(data)
    starts, ends, first = words(data, offsets, _BREAK)
    keys = [span_hashes(data, starts, ends), span_hashes(data, starts, np.minimum(ends, starts + 3)), span_hashes(data, np.maximum(starts, ends - 4), ends)]
    shift = np.uint64(48)
    salted = [(k * np.uint64(2 * i + 1)) >> shift for i, k in enumerate(keys)]
    return np.stack(salted, 1).astype(np.int64), np.diff(first)


def primary(tag):
    """The language of a tag like en-US or zh_hant, in lower case; other values in lower case."""
    return F.regexp_replace(F.lower(tag), r"^\s*([a-z]{2,3})(?:[-_].*)?\s*$", "$1")


def evidence_from_pages(pages: DataFrame) -> DataFrame:
    """key, text, declared, host, suffix of web pages (page_id, url, html)."""
    html = F.coalesce("html", F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    declared = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    plain = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    plain = F.regexp_replace(F.regexp_replace(plain, r"<[^>]*>", " "), r"&#?\w+;", " ")
    blank = lambda c: F.when(c != "", c)
    return pages.select(
        F.col("page_id").cast("long").alias("key"), plain.alias("text"), blank(declared).alias("declared"), blank(host).alias("host"),
        blank(F.regexp_extract(host, r"\.([a-z]{2,})$", 1)).alias("suffix"),
    )


def evidence_from_documents(docs: DataFrame) -> DataFrame:
    """key, text, declared, host, suffix of documents (doc_id, text, lang, source)."""
    return docs.select(F.col("doc_id").cast("long").alias("key"), "text", primary("lang").alias("declared"), F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))


def declared_languages(rows: DataFrame) -> list[str]:
    """All languages declared."""
    return sorted(r.declared for r in rows.where("declared is not null").select("declared").distinct().collect())


def learn(rows: DataFrame, names: list[str]) -> np.ndarray:
    """Log likelihoods of hashed terms: TERMS rows, a column for each language and one for `und`."""

    def tally(part, col, totals):
        found, count = terms(col)
        lang = np.repeat(part.column(0).to_numpy().astype(np.int64), count)
        totals += np.bincount((lang[:, None] * TERMS + found).ravel(), minlength=len(totals))

    table = np.full((TERMS, len(names) + 1), -np.log(TERMS), np.float32)
    for at in range(0, len(names), LOT):
        lot = names[at : at + LOT]
        code = F.array_position(F.array(*[F.lit(n) for n in lot]), F.col("declared")).cast("int") - 1
        counts = dense_counts(rows.select(code.alias("code"), "text").where("code >= 0"), tally, len(lot) * TERMS)
        counts = counts.reshape(-1, TERMS).T.astype(np.float64)
        table[:, at : at + LOT][:, : len(lot)] = np.log((counts + ALPHA) / (counts.sum(0) + ALPHA * TERMS))
    return table


def identify(rows: DataFrame, least: float = LEAST) -> DataFrame:
    """rows (key, text, declared, host, suffix) -> key, host, declared, language, posterior, accepted."""
    names = declared_languages(rows)
    table = learn(rows, names)
    n = len(names) + 1

    def likelihoods(part, col):
        found, count = terms(col)
        row = np.repeat(np.arange(len(col)), count)
        logs = np.empty((len(col), n))
        for at in range(0, n, LOT):
            each = table[:, at : at + LOT][found].sum(1)
            for k in range(each.shape[1]):
                logs[:, at + k] = np.bincount(row, each[:, k], len(col))
        logs *= (np.minimum(count, TEXT_CAP) / np.maximum(3 * count, 1))[:, None]
        logs -= logs.max(1, keepdims=True)
        share = np.exp(logs)
        share /= share.sum(1, keepdims=True)
        flat = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(col) + 1) * n, pa.int32()), pa.array(x.ravel()))
        cols = [part.column(i) for i in (0, 2, 3, 4)]
        return pa.RecordBatch.from_arrays([*cols, pa.array(count), flat(logs), flat(share)], ["key", "declared", "host", "suffix", "n_words", "logs", "share"])

    kinds = "key bigint, declared string, host string, suffix string, n_words bigint, logs array<double>, share array<double>"
    judged = cut(rows.select("key", "text", "declared", "host", "suffix").mapInArrow(per_piece(likelihoods), kinds))
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    judged = judged.withColumn("domain", F.when(domain != "", domain))
    voters = judged.where("n_words > 0")
    # One array of sums a group: expressions grow with the languages, not with their square.
    sums = F.array(*[F.sum(F.col("share")[k]) for k in range(n)])
    total = [float(x or 0.0) for x in voters.agg(sums).first()[0]]
    base = F.array(*[F.lit((x + 1.0) / (sum(total) + n)) for x in total])

    def level(key: str, parent: list) -> DataFrame:
        """The sums of a group, and its weight."""
        groups = voters.where(F.col(key).isNotNull()).groupBy(key, *parent).agg(sums.alias("s"))
        return groups.withColumn("weight", F.aggregate("s", F.lit(0.0), lambda a, x: a + x))

    def smoothed(prior):
        """Shares of a group: its sums and STRENGTH times the shares of its parent."""
        return F.zip_with("s", prior, lambda x, p: (x + STRENGTH * p) / (F.col("weight") + STRENGTH))

    suffixes = level("suffix", []).select("suffix", smoothed(base).alias("p_suffix"))
    domains = level("domain", ["suffix"]).join(suffixes, "suffix", "left").select("domain", "suffix", smoothed(F.coalesce("p_suffix", base)).alias("p_domain"))
    hosts = level("host", ["domain", "suffix"])
    hosts = hosts.join(domains.drop("suffix"), "domain", "left").join(suffixes, "suffix", "left")
    hosts = hosts.select(F.col("host").alias("h"), smoothed(F.coalesce("p_domain", "p_suffix", base)).alias("p_host"))
    near = judged.join(hosts, judged.host == hosts.h, "left")
    known = [*names, "und"]
    country = F.create_map(*[F.lit(x) for kv in COUNTRY.items() for x in kv])[F.col("suffix")]
    place = lambda c: F.coalesce(F.array_position(F.array(*[F.lit(x) for x in names]).cast("array<string>"), c), F.lit(0))
    near = near.withColumns({"said": place(F.col("declared")), "at": place(country), "prior": F.coalesce("p_host", base)})

    def evidence(at: str, k, right: float):
        """The log of `right` for the language at this place (from 1), of an equal part of the rest for the others; 0 without any."""
        return F.when(F.col(at) > 0, F.log(F.when(F.col(at) == k + 1, F.lit(right)).otherwise((1 - right) / max(n - 1, 1)))).otherwise(0.0)

    text = F.zip_with("logs", "prior", lambda x, p: x + F.log(p))
    scored = near.withColumn("post", F.transform(text, lambda p, k: p + evidence("said", k, 1 - WRONG) + evidence("at", k, 0.7)))
    top = F.array_max("post")
    odds = F.aggregate(F.transform("post", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    pick = F.element_at(F.array(*[F.lit(x) for x in known]), F.array_position("post", top).cast("int"))
    some = F.col("n_words") > 0
    out = scored.select("key", "host", "declared", F.when(some, pick).otherwise("und").alias("language"), F.when(some, 1 / odds).otherwise(0.0).alias("posterior"))
    return out.withColumn("accepted", (F.col("language") != "und") & (F.col("posterior") >= least))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is accepted, with that language in `lang`; other columns as they are."""
    # Each row whole in one column, so that no name can clash.
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    keyed = whole.select("row", F.xxhash64("row.doc_id", "row.text", "row.lang", "row.source").alias("key"))
    none = F.lit(None).cast("string")
    rows = keyed.select("key", F.col("row.text").alias("text"), primary("row.lang").alias("declared"), F.col("row.source").alias("host"), none.alias("suffix"))
    found = identify(rows).where("accepted").groupBy("key").agg(F.min("language").alias("found"))
    kept = keyed.join(found, "key")
    return kept.select(*[F.col("found").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])
