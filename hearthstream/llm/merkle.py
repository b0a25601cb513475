"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text is cut without loss into leaves (sentences, and content-defined pieces of
very long ones), leaves into paragraphs (lines), and paragraphs into sections
(text between blank lines, or content-defined runs of paragraphs).  Every node
hashes the hashes below it.  The fingerprint spells the tree out, so roots test
equality and the differing branches locate the edits.

Format: ``root!section;section;...`` where a section is its hash and, in
brackets, its paragraphs; a paragraph is its hash and its leaves; a leaf is its
hash and its length: ``9f..!a1b2c3d4[e5f60718(0a1b2c3d:42,...)...];...``.

Defined results: null counts as empty, and the empty text has a root and no
sections; two empty texts are alike by 1, an empty and a non-empty one by 0;
repeated ids are ordered by text among themselves.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.llm.common import batch_of, map_batches, range_bucket

# A leaf ends with a sentence or line; within a long one after a word with one of
# these ends (cuts that depend on the words only), and at 160 code points at last.
_LEAF = re.compile(r"[^\n.!?]{40,160}?[dens] |[^\n.!?]{1,160}(?:[.!?]+\s?|\n)?|[.!?\n]+\s?")
SECTION_BREAK = 16  # one paragraph hash in so many ends a section


def leaves_of(text: str) -> list[str]:
    """The text in pieces; joined they give the text back."""
    return _LEAF.findall(text)


def _hash(parts: list[str]) -> str:
    return xxhash.xxh3_128_hexdigest("|".join(parts).encode())


def tree(text: str | None) -> list[tuple[str, list[tuple[str, list[tuple[str, int]]]]]]:
    """Sections as (hash, paragraphs), paragraphs as (hash, leaves), leaves as (hash, length)."""
    leaves = leaves_of(text or "")
    paragraphs: list[list[str]] = [[]]
    for leaf in leaves:
        paragraphs[-1].append(leaf)
        if "\n" in leaf:
            paragraphs.append([])
    if not paragraphs[-1]:
        paragraphs.pop()
    sections: list[list[tuple[str, list[tuple[str, int]]]]] = [[]]
    for paragraph in paragraphs:
        hashed = [(xxhash.xxh3_64_hexdigest(x.encode()), len(x)) for x in paragraph]
        name = _hash([h for h, _ in hashed])
        sections[-1].append((name[:16], hashed))
        if not "".join(paragraph).strip() or int(name[-4:], 16) % SECTION_BREAK == 0:
            sections.append([])
    if not sections[-1]:
        sections.pop()
    return [(_hash([p for p, _ in s])[:16], s) for s in sections]


def fingerprint(text: str | None) -> str:
    """The tree as a string; equal for equal texts only."""
    sections = tree(text)
    # The root takes the text's own digest in, so equality does not rest on 64 bits.
    root = _hash([h for h, _ in sections] + [hashlib.sha256((text or "").encode()).hexdigest()])
    body = ";".join(
        f"{s}[" + "".join(
            f"{p}(" + ",".join(f"{h}:{n}" for h, n in leaves) + ")" for p, leaves in paragraphs
        ) + "]"
        for s, paragraphs in sections
    )
    return f"{root}!{body}"


_SECTION = re.compile(r"([0-9a-f]{16})\[([^\]]*)\]")
_PARAGRAPH = re.compile(r"([0-9a-f]{16})\(([^)]*)\)")


def _parse(print_: str):
    root, _, body = print_.partition("!")
    return root, _SECTION.findall(body)


def _weight(body: str) -> int:
    return sum(int(x.rpartition(":")[2]) for x in re.findall(r"[0-9a-f]{16}:\d+", body))


def _unmatched(left: list[tuple[str, str]], right: list[tuple[str, str]]):
    """Nodes of each side without an equal partner on the other, and the matched ones."""
    spare = Counter(h for h, _ in right)
    rest_left, matched = [], []
    for h, body in left:
        if spare[h] > 0:
            spare[h] -= 1
            matched.append(body)
        else:
            rest_left.append((h, body))
    rest_right = []
    for h, body in reversed(right):
        if spare[h] > 0:
            spare[h] -= 1
            rest_right.append((h, body))
    return rest_left, rest_right[::-1], matched


def _leaves(paragraphs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [
        tuple(leaf.split(":")) for _, body in paragraphs for leaf in body.split(",") if leaf
    ]


def _compare(a: str, b: str):
    """Unmatched leaves of both fingerprints, and the matched weight."""
    left, right, same = _unmatched(_parse(a)[1], _parse(b)[1])
    shared = sum(map(_weight, same))
    left, right, same = _unmatched(
        [p for _, body in left for p in _PARAGRAPH.findall(body)],
        [p for _, body in right for p in _PARAGRAPH.findall(body)],
    )
    shared += sum(map(_weight, same))
    left, right, same = _unmatched(_leaves(left), _leaves(right))
    shared += sum(map(int, same))
    return left, right, shared


def likeness(a: str, b: str) -> float:
    """Share of both texts (by length) that lies in common branches, 0 to 1."""
    if a.partition("!")[0] == b.partition("!")[0]:
        return 1.0
    left, right, shared = _compare(a, b)
    total = 2 * shared + sum(int(n) for _, n in left) + sum(int(n) for _, n in right)
    return 2 * shared / total if total else 0.0


def differing_spans(a: str, b: str) -> list[tuple[int, int]]:
    """Where the text of ``a`` has leaves that ``b`` lacks, as (start, end)."""
    lacking = Counter(_compare(a, b)[0])
    at, spans = 0, []
    for _, section in _parse(a)[1]:
        for leaf in _leaves(_PARAGRAPH.findall(section)):
            end = at + int(leaf[1])
            if lacking[leaf] > 0:
                lacking[leaf] -= 1
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], end)
                else:
                    spans.append((at, end))
            at = end
    return spans


def edited_text(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the next one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _in_order(documents: DataFrame, id_column: str, text: str):
    """Documents with the range bucket of their id, and the first id of every bucket.

    Buckets are cut at quantiles of the ids, one per shuffle partition of the
    session; no window or task sees all rows.
    """
    docs = documents.select(
        F.col(id_column).cast("bigint").alias("id"), F.coalesce(text, F.lit("")).alias("text")
    ).where("id is not null")
    parts = max(2, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    quantiles = [k / parts for k in range(1, parts)]
    cuts = docs.agg(F.percentile_approx("id", quantiles, 20 * parts)).first()[0]
    placed = docs.withColumn("bucket", range_bucket(F.col("id"), cuts or []))
    heads = placed.groupBy("bucket").agg(F.min("id").alias("id")).orderBy("bucket").collect()
    return placed, [(r.bucket, r.id) for r in heads]


def fingerprint_documents(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Documents are put into id order by range buckets.  A bucket also receives
    the first document of the next one (the last bucket: the very first), so
    "the next document" never needs one window over all rows.
    """
    placed, heads = _in_order(documents, id_column, text)
    heads = heads or [(0, 0)]
    # One row per bucket: its first id goes to the bucket before it as well.
    target = {heads[k][1]: heads[k - 1][0] for k in range(len(heads))}
    pairs = ",".join(f"{i}L,{b}" for i, b in target.items())
    sent = F.expr(f"map({pairs})[id]")
    firsts = (
        placed.where(F.col("id").isin([i for _, i in heads]))
        .groupBy("id").agg(F.min("text").alias("text"))
        .select("id", "text", sent.cast("int").alias("bucket"), F.lit(1).alias("extra"))
    )
    rows = (
        placed.withColumn("extra", F.lit(0)).unionByName(firsts)
        .repartition(max(1, len(heads)), "bucket")
        .sortWithinPartitions("bucket", "extra", "id", "text")
        .select("bucket", "extra", "id", "text")
    )
    schema = pa.schema(
        [(id_column, pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
         ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
         ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def work(batches):
        held = None  # (bucket, id, text, fingerprint) still waiting for its next document

        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for bucket, extra, i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                print_ = fingerprint(t)
                if held is not None and held[0] == bucket:
                    edited = edited_text(held[2], t)
                    changed = fingerprint(edited)
                    for column, value in zip(out, (
                        held[1], len(held[2]), hashlib.sha256(edited.encode()).hexdigest(),
                        held[3], changed, likeness(held[3], changed), likeness(held[3], print_),
                    ), strict=True):
                        column.append(value)
                held = None if extra else (bucket, i, t, print_)
            if out[0]:
                yield batch_of(schema, out)

    return map_batches(
        rows, work,
        f"`{id_column}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
