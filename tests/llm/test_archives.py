"""WARC archives and Merkle manifests against plain versions and their SQL."""

from __future__ import annotations

import hashlib
import io
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from llm_cases import documents, hard, no_docs  # noqa: F401
from oracle import connect, differences

from siltstone.llm import merkle, queries, warc
from siltstone.llm.common import settled

PAGE = "page_id long, url string, html string"
BIG = "x" * 1500
ROWS = [
    (1, "u1", BIG), (2, "u2", BIG), (2, "u2", BIG), (2, "u2", BIG), (1, "u1", BIG), (None, "u", BIG),
    (3, "a b\né\r\nX: y", "tiny"), (3, "a b\né\r\nX: y", "tiny"), (4, None, None), (5, None, ""), (6, "z", "y" * 1000),
    (7, "z", "y" * 1000), (8, "z", "y" * 999), (9, "z", "y" * 999), (None, None, "q" * 1000), (None, None, "q" * 1000),
    (None, "b", "r" * 2000), (-5, "n", "WARC/1.1\r\n\r\nContent-Length: 3\r\n" * 50), (2**62, "m", "é" * 700_000),
]


def page_order(page_id, url):
    return ((page_id is not None, page_id or 0), (url is not None, url or ""))


def plainly(rows) -> Counter:
    best, out, seen = {}, Counter(), set()
    for page_id, url, html in rows:
        if len((html or "").encode()) >= 1000:
            best[html] = max(best.get(html, page_order(None, None)), page_order(page_id, url))
    for page_id, url, html in rows:
        data, at = (html or "").encode(), (html, page_order(page_id, url))
        response = len(data) < 1000 or (best[html] == at[1] and at not in seen)
        seen.add(at)
        kept = None if response or not best[html][0][0] else best[html][0][1]
        out[page_id, len(data), hashlib.sha1(data).hexdigest(), "response" if response else "revisit", kept] += 1
    return out


def read_back(manifest, folder) -> Counter:
    return Counter(map(tuple, warc.resolved(settled(warc.read_records(manifest, folder), "records")).collect()))


@pytest.mark.parametrize("shard_bytes, roll", [((8 << 20, 4 << 30), 256 << 20), ((2000, 2000), 300)])
def test_archives_read_back(spark, monkeypatch, shard_bytes, roll):
    """Copies, repeated rows, NULLs, line ends in urls and payloads, one shard or many, files rolled early."""
    monkeypatch.setattr(warc, "SHARD_BYTES", shard_bytes)
    pages = spark.createDataFrame([(*r, 1, "k") for r in ROWS], PAGE + ", copy int, key string")
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(pages, folder, roll=roll)
    assert read_back(manifest, folder) == plainly(ROWS)
    again = warc.archive_folder(spark)
    other = warc.write_archives(pages.repartition(5), again, roll=roll)
    assert sorted(map(tuple, manifest.collect())) == sorted(map(tuple, other.collect()))  # the same bytes
    texts = warc.read_records(manifest, folder, with_payload=True).where("record_type = 'response'")
    assert {r.payload for r in texts.collect()} == {html or "" for *_, html in ROWS}
    system, root = fs.FileSystem.from_uri(folder)
    left = {x.base_name for x in system.get_file_info(fs.FileSelector(root))}
    assert left == {"_manifest", *(r.name for r in manifest.collect())}


def test_many_equal_rows_and_copies(spark, monkeypatch):
    """A third of all rows equal in everything, another third copies under their own ids."""
    monkeypatch.setattr(warc, "SHARD_BYTES", (50_000, 50_000))
    monkeypatch.setattr(warc, "COPIES", 7)
    rows = [(1, "u", BIG)] * 300 + [(k, "v", "w" * 1200) for k in range(2, 302)] + [(5, "s", "small")] * 100
    rows += [(k, "o", f"{k}" * 400) for k in range(400, 700)]
    pages = spark.createDataFrame(rows, PAGE)
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(pages, folder)
    assert read_back(manifest, folder) == plainly(rows) and manifest.count() > 5


def test_no_pages(spark):
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(spark.createDataFrame([], PAGE), folder)
    assert manifest.count() == 0 and read_back(manifest, folder) == Counter()


def test_commit_may_run_twice_and_damage_is_seen(spark):
    folder = warc.archive_folder(spark)
    system, root = fs.FileSystem.from_uri(folder)
    writer = warc.ArchiveWriter(folder, 0, 1 << 20, "2000-01-01T00:00:00Z")
    row = dict(page_id=1, url="u", key="k", copy=0, kind=1, html="hello", n_bytes=5, sha1=None, kept=None)
    writer.write(warc.page_record(row, "2000-01-01T00:00:00Z"))
    lost = warc.ArchiveWriter(folder, 0, 1 << 20, "2000-01-01T00:00:00Z")  # an attempt that was lost
    lost.write(b"half a record")
    made = spark.createDataFrame(writer.end(), warc.DRAFTS_TYPE)
    for _ in range(2):
        manifest = warc.commit(made, folder)
        assert read_back(manifest, folder) == plainly([(1, "u", "hello")])
    data = bytearray()
    with system.open_input_stream(f"{root}/{writer.files[0][0]}", compression=None) as source:
        data += source.read()
    import gzip

    whole = gzip.decompress(bytes(data)).replace(b"hello", b"hallo")
    with pytest.raises(ValueError, match="damaged"):
        list(warc.records_in(io.BytesIO(gzip.compress(whole))))


@pytest.mark.parametrize("key", ["op12_warc", "op13_merkle_manifest"])
def test_queries_equal_their_sql(spark, small, key):
    found = queries.QUERIES[key](spark, small).toPandas()
    assert differences(found, connect(small).execute(queries.ORACLES[key]).df()) is None


# ---- Merkle ------------------------------------------------------------------------------------

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(digests: list[str]) -> list[list[str]]:
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels: list[list[str]], number: int) -> list[tuple[int, list[str]]]:
    path = []
    for level in levels[:-1]:
        path.append((number % 16, level[number // 16 * 16 : number // 16 * 16 + 16]))
        number //= 16
    return path


def proved_plainly(rows) -> Counter:
    trees: dict = {}
    for r in rows:
        lowered = r[-1] and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[-1])
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        own = leaf_of(r)
        trees.setdefault(r[1], []).append((r[0], own, leaf_of((*r[:-1], lowered)) if tampered else own))
    sources = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for own in trees.values():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    built = {s: levels_of([t[1] for t in trees[s]]) for s in sources}
    top = levels_of([built[s][-1][0] for s in sources])
    out = Counter()
    for k, s in enumerate(sources):
        for number, (doc_id, own, claimed) in enumerate(trees[s]):
            path = path_of(built[s], number) + path_of(top, k)
            proof = sha("".join(x for at, group in path for i, x in enumerate(group) if i != at))
            for at, group in path:
                claimed = sha("".join([*group[:at], claimed, *group[at + 1 :]]))
            out[doc_id, own, built[s][-1][0], top[-1][0], proof, claimed, claimed == top[-1][0]] += 1
    return out


def proofs_of(docs) -> Counter:
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    when = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    return Counter(map(tuple, merkle.document_proofs(docs, FIELDS, {"text": lowered}, when).collect()))


@pytest.mark.parametrize("part", [4096, 5])
def test_proofs_of_documents(spark, documents, monkeypatch, part):
    monkeypatch.setattr(merkle, "PART_LEAVES", part)
    assert proofs_of(documents) == proved_plainly([tuple(r) for r in documents.select(*FIELDS).collect()])


@pytest.mark.parametrize("part", [4096, 50])
def test_hot_source_many_sources_and_repeated_rows(spark, monkeypatch, part):
    """One source with most rows, sources with one row, NULL and equal ids, equal rows, odd names."""
    monkeypatch.setattr(merkle, "PART_LEAVES", part)
    rows = [(k, "hot", "en", 1, f"Text {k}") for k in range(700)] + [(k, f"s{k}", None, None, "A b") for k in range(40)]
    rows += [(None, None, None, None, None), (3, "", "de", 2, ""), (3, "é", "de", 2, "X"), (3, "z", "de", 2, "X")]
    rows += [(9, "hot", "en", 1, "same")] * 300 + [(None, "hot", "en", 1, "no id")] * 20 + [(5, "seventeen", None, k, "T") for k in range(17)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    found = proofs_of(docs.withColumns({"number": F.lit(1), "tree": F.lit("t"), "digest": F.lit(2)}))
    assert found == proved_plainly(rows)


def test_hard_documents_and_none(hard, no_docs):
    docs = hard.toDF(*hard.columns[:5], "number", "part", "n", "c0")
    assert proofs_of(docs) == proved_plainly([tuple(r)[:1] + (r.source, r.lang, r.n_chars, r.text) for r in hard.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    assert proofs_of(no_docs) == Counter()


def test_multiproof_asks_for_the_fewest_nodes():
    """Every subset of leaves: what is asked for is needed, and with the leaves it is enough."""
    rng = np.random.default_rng(2)
    for n in (1, 2, 16, 17, 300, 4097):
        levels = levels_of([sha(str(k)) for k in range(n)])
        for size in (1, 3, n // 2 + 1):
            numbers = np.unique(rng.integers(0, n, size))
            leaves = pd.DataFrame({"tree": 0, "number": numbers, "n": n, "digest": [levels[0][k] for k in numbers]})
            asked = merkle.missing_nodes(leaves, 1)
            covered = set()  # nodes that follow from the leaves
            for level in range(len(levels)):
                covered |= {(level, k // 16**level) for k in numbers.tolist()}
            wanted = {
                (level, c)
                for level, k in covered
                if level
                for c in range(16 * k, min(16 * k + 16, len(levels[level - 1])))
                if (level - 1, c) not in covered
                for level in [level - 1]
            }
            assert set(zip(asked["level"], asked["number"])) == wanted and len(asked) == len(wanted)
            nodes = asked.assign(digest=[levels[a][b] for a, b in zip(asked["level"], asked["number"])])
            assert merkle.Octopus(leaves, nodes, 1).root == levels[-1][0]
