"""The Merkle manifest against trees built in plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from snapwatch.llm import merkle
from snapwatch.llm.queries import QUERIES

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, lo int, digest string, children int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_hash(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def above(nodes):
    return [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]


def climb(nodes, at):
    """Root and path of the node at this place."""
    path = []
    while len(nodes) > 1:
        run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
        path.append((run[: at % 8], run[at % 8 + 1 :]))
        nodes, at = above(nodes), at // 8
    return nodes[0], path


def brute(rows):
    """(doc_id, leaf, subroot, root, siblings) of every row (doc_id, source, lang, n_chars, text)."""
    order = lambda v: (v is not None, v if v is not None else 0)
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], row_hash(row)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda r: (order(r[0]), r[1]))
    subroots = [climb([h for _, h in groups[lang]], 0)[0] for lang in langs]
    out = []
    for place, lang in enumerate(langs):
        leaves = [h for _, h in groups[lang]]
        root, upper = climb(subroots, place)
        for at, (doc, leaf) in enumerate(groups[lang]):
            path = climb(leaves, at)[1] + upper
            out.append((doc, leaf, subroots[place], root, "".join("".join(b + a) for b, a in path)))
    return sorted(out, key=str)


def made(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "d", 2) for r in rows], DOCS)


def got(docs):
    leaves = docs.withColumn("leaf", merkle.row_digest())
    rows = merkle.manifest(leaves, "lang", "doc_id", "leaf")
    told = rows.select("row.doc_id", "leaf", "subroot", "root", merkle.siblings(F.col("path")), merkle.fold(F.col("leaf"), F.col("path")).alias("again"))
    found = [tuple(r) for r in told.collect()]
    assert all(r[3] == r[5] for r in found)
    return sorted((r[:5] for r in found), key=str)


def doc(i, lang="en", text="some Text"):
    return (i, "web", lang, 9, text)


CASES = {
    "one": [doc(1)],
    "one of each of many languages": [doc(i, f"l{i:02}") for i in range(20)],
    "full and broken runs": [doc(i) for i in range(73)] + [doc(100 + i, "de") for i in range(8)] + [doc(200 + i, "fr") for i in range(9)],
    "one past a power": [doc(i * 3, text=f"{i}") for i in range(513)],
    "nulls, empty and repeated rows": [doc(None), doc(None), (None,) * 5, doc(4, None), doc(5, ""), doc(5, ""), doc(6, "é", ""), doc(6, "z", None)]
    + [doc(7)] * 30
    + [doc(-3, "en", "Ünï €" * 2000)],
}


@pytest.mark.parametrize("case", CASES)
def test_manifest(spark, case):
    assert got(made(spark, CASES[case])) == brute(CASES[case])


def test_no_rows(spark):
    assert got(made(spark, [])) == []


def test_query_finds_what_was_changed(spark, tmp_path):
    import zlib

    rows = [doc(i, text="Capital" if i % 2 else "small") for i in range(60)] + [doc(None), doc(61, text=None)]
    made(spark, rows).drop("tree", "lo", "digest", "children").write.parquet(str(tmp_path / "documents.parquet"))
    for r in QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect():
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.doc_id % 2 == 1 and r.doc_id < 60
        assert r.verified == (not changed) == (r.folded_root == r.root)
