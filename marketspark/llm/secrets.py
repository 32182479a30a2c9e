"""Secret scan with corpus-wide ownership: a value that several owners hold is a copied example, not a live key.

Every document is scanned once for candidates. Their hashes are counted by distinct repositories and owners
over the whole corpus; a value of one owner looks live, a value of more than ``max_owners`` owners is copied.
With ``by_text`` copies of one text are one witness, whoever holds them, so that crawl copies of a live key
do not make it an example.
Named formats add spans in any case; a quoted opaque string is a span only if its value looks live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from marketspark.llm.common import broadcast_if_small, stored, text_slices
from marketspark.llm.near_duplicates import near_duplicates

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
# Formats with a mark that names the issuer or the container, as their issuers document them.
NAMED = {
    "forge": (("gh",), re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    "chat": (("xox",), re.compile(r"xox[abprs]-[A-Za-z0-9-]{20,}")),
    "signed": (("eyJ",), re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "pem": (("PRIVATE KEY",), re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")),
    "login": (("://",), re.compile(r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]*+:([^\s:/@]{6,}+(?=@)|[^\s/@\"'`<>]{6,}+)@")),
}
# With marks that paths and sentences also have, a stretch of twenty characters must have none of them.
OPAQUE = re.compile(r"[\"'`]([A-Za-z0-9+/_=.~!@#$%^&*-]{20,}+)[\"'`]")
PLAIN = re.compile(r"[A-Za-z0-9+/_=-]+")
STRETCH = re.compile(r"[A-Za-z0-9+_=-]{20}")
OPAQUE_BITS = 3.5
KINDS = ("assign", "access", "hex", *NAMED, "opaque")


def bits(value: str) -> float:
    """Entropy of the characters of a value, in bits for each."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the three base kinds, leftmost and without overlap within a kind."""
    spans, low = [], text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(spans)


def more_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Spans of the named formats, and opaque quoted strings that no other span touches."""
    spans = []
    for kind, (marks, pattern) in enumerate(NAMED.values(), start=3):
        if all(mark in text for mark in marks):
            spans += [(m.start(), kind, m.end(), m[m.lastindex or 0]) for m in pattern.finditer(text)]
    taken = [(s, e) for s, _, e, _ in [*base, *spans]]
    for m in OPAQUE.finditer(text):
        value = m[1]
        if (re.search("[0-9]", value) and re.search("[A-Za-z]", value) and bits(value) >= OPAQUE_BITS
                and (PLAIN.fullmatch(value) or STRETCH.search(value))
                and not any(s < m.end(1) and m.start(1) < e for s, e in taken)):
            spans.append((m.start(1), len(KINDS) - 1, m.end(1), value))
    return spans


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, *_ in spans)


CANDIDATE = "struct<at:bigint,kind:int,till:bigint,value:binary>"
SCANNED = f"doc_id long, version long, repository string, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, candidates array<{CANDIDATE}>"
ARROW_CANDIDATE = pa.list_(pa.struct([("at", pa.int64()), ("kind", pa.int32()), ("till", pa.int64()), ("value", pa.binary())]))


def scanned(docs: DataFrame) -> DataFrame:
    """Counts, digest and candidates (place, kind, value's hash) of each row; the text goes no further."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            counts, digests, candidates = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                found = sorted([*base, *more_spans(text or "", base)])
                counts.append(Counter(kind for _, kind, _, _ in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                candidates.append([
                    {"at": s, "kind": k, "till": e, "value": hashlib.sha256(v.encode()).digest()[:16]} for s, k, e, v in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), batch.column("repository"), batch.column("owner"),
                 *[pa.array([c[k] for c in counts], pa.int64()) for k in range(3)],
                 pa.array(digests, pa.string()), pa.array(candidates, ARROW_CANDIDATE)],
                ["doc_id", "version", "repository", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "candidates"],
            )

    return docs.mapInArrow(scan, SCANNED)


def ownership(candidates: DataFrame) -> DataFrame:
    """For each value its distinct repositories and owners, counted exactly and first within each task."""
    places = candidates.groupBy("value", "repository", "owner").agg(F.count(F.lit(1)).alias("n"))
    owners = places.groupBy("value", "owner").agg(F.sum("n").alias("n"), F.count("repository").alias("repositories"))
    return owners.groupBy("value").agg(
        F.sum("n").alias("n_rows"), F.sum("repositories").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"))


def witnesses(places: DataFrame, groups: DataFrame) -> DataFrame:
    """For each value its distinct repositories and owners, of which each group of near copies of a text has one.

    ``places`` has value, repository, owner and version of each candidate; ``groups`` the group of each version.
    """
    each = places.groupBy("value", "repository", "owner", "version").agg(F.count(F.lit(1)).alias("n"))
    first = each.join(groups, "version").groupBy("value", "text_group").agg(
        F.sum("n").alias("n"), F.min(F.struct("owner", "repository")).alias("witness"))
    held = first.groupBy("value", "witness.owner", "witness.repository").agg(F.sum("n").alias("n"))
    return held.groupBy("value").agg(
        F.sum("n").alias("n_rows"), F.count_distinct("repository").alias("n_repositories"), F.count_distinct("owner").alias("n_owners"))


def text_groups(source: DataFrame, versions: DataFrame) -> DataFrame:
    """(version, text_group) of ``versions``: near copies (five words, 0.8) are one group, and so is a text by itself."""
    texts = source.join(broadcast_if_small(stored(versions, "shared-versions")), "version", "left_semi")
    once = stored(texts.groupBy("version").agg(F.min("text").alias("text")), "shared-texts")
    return near_duplicates(once, id_column="version").select(
        F.col("doc_id").alias("version"), F.col("component_id").alias("text_group"))


def scan_secrets(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", repository_column: str = "source",
    owner: str | None = None, max_owners: int = 1, by_text: bool = False,
) -> DataFrame:
    """One row for each row of ``docs``: base counts and digest, version, ``spans``, ``verdicts``, n_live, n_copied.

    ``version`` (xxhash64 of the text) tells apart texts that share an id. ``owner`` is a column expression; without it the owner is the repository's part before the first slash.
    ``spans`` lists kind:start:end (code points, end exclusive) of all spans by start, then kind;
    ``verdicts`` says live or copied for each in the same order. A null or empty text has no span. Rows with
    no repository count as one owner of their own name, ''. Repeated rows each give a row and are one
    repository's. Extra columns are left out; an empty table gives an empty result.

    With ``by_text`` a value is copied only if it has more than ``max_owners`` repositories and as many owners,
    counted over groups of near copies: each group is one witness, the first of its owners.

    The text is read once and never shuffled; with ``by_text`` those that hold a value of several owners are
    read again and grouped. A value that very many rows hold is one row a task after the first aggregate, and
    only the values of several owners are joined back.
    """
    repository = F.coalesce(F.col(repository_column).cast("string"), F.lit(""))
    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"),
        F.xxhash64(F.col(text_column).cast("string")).alias("version"), repository.alias("repository"),
        (F.expr(owner) if owner else F.substring_index(repository, "/", 1)).cast("string").alias("owner"),
    )
    rows = stored(scanned(source).withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    exploded = rows.select("row", "repository", "owner", F.inline("candidates"))
    many = ownership(exploded).filter(F.col("n_owners") > max_owners)
    if by_text:
        shared = broadcast_if_small(stored(many.select("value"), "shared-values"))
        places = stored(rows.select("repository", "owner", "version", F.inline("candidates")).join(shared, "value").select(
            "value", "repository", "owner", "version"), "shared-places")
        seen = witnesses(places, text_groups(source, places.select("version").distinct()))
        many = stored(seen.filter((F.col("n_owners") > max_owners) & (F.col("n_repositories") > max_owners)), "copied-values")
    copied = many.select("value", F.lit(True).alias("copied"))
    names = F.array(*[F.lit(k) for k in KINDS])
    span = F.concat_ws(":", F.element_at(names, F.col("s.kind") + 1), F.col("s.at"), F.col("s.till"))
    settled = (
        exploded.join(copied, "value", "left")
        .select("row", F.struct("at", "kind", "till", F.coalesce("copied", F.lit(False)).alias("copied")).alias("s"), )
        .filter((F.col("s.kind") != len(KINDS) - 1) | ~F.col("s.copied"))
        .select("row", F.struct(
            F.col("s.at").alias("at"), F.col("s.kind").alias("kind"), span.alias("span"),
            F.when(F.col("s.copied"), "copied").otherwise("live").alias("verdict")).alias("s"))
        .groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("s"))
        .select(
            "row", F.array_join("s.span", ",").alias("spans"), F.array_join("s.verdict", ",").alias("verdicts"),
            F.size(F.filter("s.verdict", lambda v: v == "live")).cast("long").alias("n_live"),
            F.size(F.filter("s.verdict", lambda v: v == "copied")).cast("long").alias("n_copied"))
    )
    base = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "version"]
    found = rows.filter(F.size("candidates") > 0).select("row", *base).join(settled, "row", "left").select(
        *base, F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("verdicts", F.lit("")).alias("verdicts"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"))
    none = rows.filter(F.size("candidates") == 0).select(
        *base, F.lit("").alias("spans"), F.lit("").alias("verdicts"),
        F.lit(0).cast("long").alias("n_live"), F.lit(0).cast("long").alias("n_copied"))
    return found.unionByName(none)


REMOVED = "[secret removed]"


def without_secrets(text: str, spans: str, verdicts: str, keep_copied: bool) -> str:
    """``text`` with a mark in place of its spans; spans that overlap get one mark."""
    out, at = [], 0
    for span, verdict in zip(spans.split(","), verdicts.split(","), strict=True):
        _, start, end = span.split(":")
        if verdict == "live" or not keep_copied:
            if int(start) >= at:
                out += [text[at:int(start)], REMOVED]
            at = max(at, int(end))
    return "".join(out) + text[at:]


def redact(
    docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_copied: bool = False,
) -> DataFrame:
    """``docs`` with the secrets of ``found`` (a result of ``scan_secrets`` over them) taken out; all columns stay.

    Every span goes: an assignment, an access key or an issuer's format is no less a secret for being held by
    others, and opaque strings are spans only while they look live. ``keep_copied`` leaves copied values in. A row
    without id is told by its text alone. Null and empty texts, and texts without a span, stay as they are, texts of
    any length are rewritten whole, and repeated rows alike. Columns may have any name; an empty table gives an
    empty result.
    """
    columns = docs.columns

    def free(name: str) -> str:
        while name.lower() in {c.lower() for c in columns}:
            name += "_"
        return name

    own_id, version, spans, verdicts = (free(c) for c in ("found_id", "found_version", "found_spans", "found_verdicts"))
    chosen = found.filter(F.col("n_live") + F.lit(0 if keep_copied else 1) * F.col("n_copied") > 0)
    hit = stored(chosen.select("doc_id", "version", "spans", "verdicts").distinct(), "found-secrets").toDF(own_id, version, spans, verdicts)
    same = docs[id_column].cast("long").eqNullSafe(hit[own_id]) & (F.xxhash64(docs[text_column]) == hit[version])
    hit = broadcast_if_small(hit)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_column):
            rows = zip(*(batch.column(c).to_pylist() for c in (text_column, spans, verdicts)), strict=True)
            texts = pa.array([without_secrets(*row, keep_copied) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([texts if c == text_column else batch.column(c) for c in columns], columns)

    changed = docs.join(hit, same).drop(own_id, version).mapInArrow(rewrite, docs.schema)
    return docs.join(hit, same, "left_anti").unionByName(changed)
