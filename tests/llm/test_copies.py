"""Repeated passages, SimHash groups and components against brute force."""

import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from snapwatch.llm import passages, simhash
from snapwatch.llm.components import connected_components
from snapwatch.session import shuffles_freed

DOCS = "doc_id long, text string, component_id long, key long, fp string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, 8, "x") for i, t in rows], DOCS)


def words(pick, n, size=3000):
    return [f"w{pick.randrange(size)}" for _ in range(n)]


def groups_of(links, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    pick = random.Random(5)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)] + [(900, 900 - i) for i in range(1, 50)]
    got = connected_components(spark.createDataFrame([*edges, (None, 3), (4, None), edges[0]], "a long, b long")).collect()
    want = groups_of(edges, {n for e in edges if e[0] != e[1] for n in e})
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def by_definition(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def test_fingerprints():
    for text in [None, "", " \t\n", "One", "one TWO three", "ÄB cd Ef gh ij", "a b c d " * 300, "x\x0by\x0cz\rw   v"]:
        assert simhash.fingerprint(text or "") == by_definition(text)


def test_groups_of_fingerprints(spark):
    """Chains, stars and random neighbours, with every way to split few bits over the segments."""
    pick = random.Random(11)
    values = [0, (1 << 64) - 1]
    for _ in range(60):
        base = pick.getrandbits(64)
        values.append(base)
        for _ in range(pick.randrange(8)):
            near = base
            for bit in pick.sample(range(64), pick.randrange(1, 7)):
                near ^= 1 << bit
            values.append(near)
            base = near if pick.random() < 0.4 else base
    crowd = pick.getrandbits(64)
    values += [crowd ^ sum(1 << bit for bit in pick.sample(range(64), pick.randrange(5))) for _ in range(300)]
    rows = [(i, int(np.uint64(v).astype(np.int64))) for i, v in enumerate(values)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (None, 12345)]
    got = simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, fingerprint long")).collect()
    links = [(i, j) for i in range(len(values)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= 4]
    want = groups_of(links, range(len(values)))
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    lone = [r for r in got if r.fingerprint == 12345]
    assert lone[0].component_id is None


def test_one_of_each_stays(spark):
    pick = random.Random(2)
    text = words(pick, 300)
    near = text[:150] + ["other"] + text[151:]
    rows = [(9, " ".join(text)), (4, " ".join(near)), (4, " ".join(near)), (6, " ".join(words(pick, 300))), (None, "none"), (None, "none"), (8, None), (7, "")]
    if bin(simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[1][1])).count("1") > 4:
        pytest.fail("the fixture's copies are not near")
    docs = frame(spark, rows)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 4, 6, 7]
    assert simhash.keep_one_of_each(docs.limit(0)).collect() == []


def test_compact_windows():
    pick = np.random.default_rng(0)
    for n, size in [(5, 9), (9, 9), (10, 3), (80, 40), (300, 1 << 60), (300, 6)]:
        h = pick.integers(0, size, n).astype(np.uint64)
        want = set()
        for i in range(n):
            a, b = i, i
            while a > 0 and h[a - 1] > h[i]:
                a -= 1
            while b < n - 1 and h[b + 1] >= h[i]:
                b += 1
            if b - a >= 9:
                want.add((i, a, b))
        assert set(zip(*(x.tolist() for x in passages.compact_windows(h, 10)))) == want


def test_words_are_hashed_as_they_are(monkeypatch):
    text = "  Foo bar\n\tfoo  BAR x\x0by " * 40
    whole = passages.word_hashes(text.encode())
    assert len(whole) == 240 and len(set(whole.tolist())) == 4
    monkeypatch.setattr(passages, "BLOCK", 16)  # words at the ends of blocks
    assert passages.word_hashes(text.encode()).tolist() == whole.tolist()
    assert len(passages.word_hashes(b" \n")) == 0


def test_passages(spark):
    """Planted passages of 50 words and more are found with their classes, shorter ones and clean texts are not."""
    pick = random.Random(4)
    shared = [words(pick, n) for n in (51, 60, 200, 40)]
    texts, holds = {}, defaultdict(set)
    for doc in range(60):
        parts = [words(pick, pick.randrange(40, 120))]
        for number in {doc % 7, doc % 11} & {0, 1, 2, 3}:
            parts += [shared[number], words(pick, pick.randrange(30, 90))]
            holds[number].add(doc)
        texts[doc] = " ".join(w for p in parts for w in p)
    texts[60] = " ".join(words(pick, 50) + shared[2][:100] + ["inserted"] + shared[2][100:])
    holds[2].add(60)
    texts[61] = texts[62] = " ".join(words(pick, 400))
    rows = [*texts.items(), (63, None), (64, ""), (None, texts[61]), (65, "short text"), (66, " ".join(words(pick, 60_000, 10**9))), (61, texts[61])]
    got = passages.repeated_passages(frame(spark, rows)).collect()
    classes = defaultdict(set)
    for r in got:
        classes[r.class_id].add(r.doc_id)
        assert r.n_words >= 50
    assert {r.doc_id for r in got} == holds[0] | holds[1] | holds[2] | {61, 62}
    for number in range(3):
        assert any(holds[number] <= members for members in classes.values())
    assert classes[61] == {61, 62} and all(r.n_docs == len(classes[r.class_id]) for r in got)
    place = texts[1].split().index(shared[1][0])
    assert any(r.doc_id == 1 and r.start_word <= place and r.start_word + r.n_words >= place + 60 for r in got)
    assert passages.repeated_passages(frame(spark, [])).collect() == []


def changed(text, *places):
    return passages.shingle_hashes(" ".join("changed" if i in places else w for i, w in enumerate(text)).encode())


def test_a_passage_like_a_linked_one_only(spark):
    """Of three documents the second is like the first and the third, which are not alike: all three are one class."""
    pick, rows = random.Random(8), []
    for number in range(0, 36, 3):
        one = words(pick, 60, 10**6)
        two = [*one[:25], "two", *one[26:]]
        three = [*two[:35], "three", *two[36:]]
        rows += [(number + i, " ".join([*words(pick, 20, 10**6), *part, *words(pick, 20, 10**6)])) for i, part in enumerate((one, two, three))]
    found = {r.doc_id: r.class_id for r in passages.repeated_passages(frame(spark, rows)).collect()}
    assert sum(found.get(number + i) == number for number in range(0, 36, 3) for i in (1, 2)) >= 23


def test_similar_passages_are_measured():
    pick = random.Random(9)
    text = words(pick, 50)
    a = changed(text)
    assert passages.alike(a, a, 46) == [(0, 46, 0, 46)]
    assert passages.alike(a, changed(text, 25), 46) == [(0, 46, 0, 46)]  # 41 of 51 shingles
    assert passages.alike(a, changed(text, 1), 46) == []  # what is shared has 48 words
    assert passages.alike(changed([*text, "x"]), changed([*text, "y"]), 46) == [(0, 46, 0, 46)]
    assert passages.alike(a, changed(text, 15, 35), 46) == []
    long = [*words(pick, 30, 10**9), *text, *words(pick, 200, 10**9), *text[::-1] * 2, *words(pick, 20, 10**9)]
    other = [*text[::-1] * 2, *words(pick, 99, 10**9), *text]
    found = sorted(passages.alike(changed(long), changed(other), 46))
    assert [f[:2] for f in found] == [(30, 76), (280, 376)] and found[0][2:] == (199, 245)


def test_similar_passages_of_unequal_length():
    """Insertions lengthen one side only; a stretch that is too long is searched inside."""
    pick = random.Random(12)
    text = words(pick, 50, 10**9)
    a, b = changed(text), changed([*text[:25], "x", "y", *text[25:]])
    assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) > 0.8
    assert passages.alike(b, a, 46) == [(0, 48, 0, 46)] and passages.alike(a, b, 46) == [(0, 46, 0, 48)]
    tail = words(pick, 9, 10**9)  # held by both sides, with other words in between
    one = changed([*text, *words(pick, 6, 10**9), *tail])
    two = changed([*tail, *words(pick, 90, 10**9), *text])
    assert [f[:2] for f in passages.alike(one, two, 46)] == [(0, 46)]


def partners(spark, texts):
    """{doc: docs of its class} of the passages found."""
    classes = defaultdict(set)
    rows = passages.repeated_passages(frame(spark, list(texts.items()))).collect()
    for r in rows:
        classes[r.class_id].add(r.doc_id)
    return {d: members for members in classes.values() for d in members}


def test_passages_with_insertions(spark):
    """Copies of 50 to 100 words with one or two inserted words (Jaccard 0.8 and more), whose places differ by side of the edit."""
    pick = random.Random(21)
    texts, copies = {}, 60
    for i in range(copies):
        text = words(pick, pick.randrange(50 if i % 2 else 85, 101), 10**9)
        other, places = list(text), [len(text) // 2] if i % 2 else [len(text) // 3, 2 * len(text) // 3]
        for place in reversed(places):
            other.insert(place, "inserted")
        for doc, middle in ((2 * i, text), (2 * i + 1, other)):
            texts[doc] = " ".join([*words(pick, 80, 10**9), *middle, *words(pick, 80, 10**9)])
    got = partners(spark, texts)
    found = sum(2 * i + 1 in got.get(2 * i, ()) for i in range(copies))
    assert found >= 0.95 * copies


def test_minima_on_both_sides_of_an_insertion(spark):
    """Just one function's minimum before the inserted word and one after it: no two agree at one shift."""
    pick = random.Random(22)
    texts, least = {}, 46
    while len(texts) < 16:
        text = words(pick, 50, 10**9)
        a, b = passages.shingle_hashes(" ".join(text).encode()), passages.shingle_hashes(" ".join([*text[:25], "inserted", *text[25:]]).encode())
        ranks = [(passages._mixed(a, n), passages._mixed(b, n)) for n in range(passages.HASHES)]
        agreeing = [int(one.argmin()) for one, two in ranks if one.min() == two.min()]
        if len(agreeing) != 2 or min(agreeing) > 20 or max(agreeing) < 25 or len(a) != least:
            continue
        for middle in (text, [*text[:25], "inserted", *text[25:]]):
            texts[len(texts)] = " ".join([*words(pick, 80, 10**9), *middle, *words(pick, 80, 10**9)])
    got = partners(spark, texts)
    assert all(got.get(d) == {d, d + 1} for d in range(0, len(texts), 2))


@pytest.mark.parametrize("together", [256, 3])
def test_first_document_is_no_copy(spark, monkeypatch, together):
    """Documents of lower ids hold a variant of 60 % that keeps every minimum of the passage; the exact repeats meet."""
    monkeypatch.setattr(passages, "TOGETHER", together)
    pick = random.Random(23)
    texts, n = {}, 9
    for group in range(6):
        text = words(pick, 60, 10**9)
        ranks = passages.shingle_hashes(" ".join(text).encode())
        places = sorted({int(passages._mixed(ranks, n).argmin()) for n in range(passages.HASHES)})
        kept = {p + i for p in places for i in range(passages.SHINGLE_WORDS)}
        for member in range(n):
            # Six variants, each with words of its own around the minima, and three copies.
            middle = [w if member >= 6 or i in kept else f"x{group}y{member}z{i}" for i, w in enumerate(text)]
            texts[group * n + member] = " ".join([*words(pick, 80, 10**9), *middle, *words(pick, 80, 10**9)])
    got = partners(spark, texts)
    for group in range(6):
        first = group * n + 6
        assert got.get(first) == {first, first + 1, first + 2}
    assert len(got) == 18


def test_split_values_change_nothing(spark):
    """Values that are split into parts give the same pairs as others."""
    pick = random.Random(24)
    phrase, text = words(pick, 12, 10**9), words(pick, 60, 10**9)
    middles = [[*phrase, *text] if d % 3 else phrase for d in range(30)]
    rows = [(d, " ".join([*words(pick, 60, 10**9), *m, *words(pick, 60, 10**9)])) for d, m in enumerate(middles)]
    found = passages.windows(spark.createDataFrame(rows, "doc long, text string"))
    pairs = [passages._shared(found, s).where("doc > w.doc").select("key", "doc", "centre", "w.*").collect() for s in (found, found.limit(0))]
    assert pairs[0] and sorted(map(tuple, pairs[0])) == sorted(map(tuple, pairs[1]))


def runs_of(count, length, gap):
    """Two texts' shingles: runs that both hold, with others in between."""
    sides = ([], [])
    for run in range(count):
        for side, out in enumerate(sides):
            out += range(run * 1000, run * 1000 + length)
            if run < count - 1:
                out += [10**6 * (side + 1) + run * 1000 + i for i in range(gap)]
    return [np.array(s, np.uint64) for s in sides]


def test_a_stretch_of_many_runs_is_covered_by_its_similar_parts():
    for count in (4, 8, 9, 12, 16, 40):
        a, b = runs_of(count, 35, 5)
        found = passages.alike(a, b, 46)
        held = np.zeros(len(a), bool)
        for start, end, other, last in found:
            one, two = set(a[start:end].tolist()), set(b[other:last].tolist())
            assert len(one & two) >= 0.8 * len(one | two) - 1e-6
            held[start:end] = True
        # Four runs of 35 with gaps of 5 are similar, and so are eight; what is left over is shorter than that.
        assert held.sum() >= len(a) - 4 * 40
        assert count == 9 or held.sum() >= len(a) - count * 5


def test_overlapping_ranges_of_one_signature_are_one():
    columns = [np.array(x) for x in zip(*[
        # sig, row, doc, start, end, lo, hi
        (5, 0, 9, 10, 80, 12, 20), (5, 0, 9, 79, 130, 100, 101), (5, 0, 9, 130, 190, 140, 150),
        (5, 1, 4, 20, 90, 30, 40), (6, 0, 9, 10, 80, 12, 20), (6, 0, 9, 10, 200, 40, 60),
    ])]
    got = sorted(zip(*(x.tolist() for x in passages._merged(*columns))))
    assert got == [
        (5, 4, 20, 90, 30, 40, 10, 50), (5, 9, 10, 130, 12, 101, 21, 60), (5, 9, 130, 190, 140, 150, 10, 40),
        (6, 9, 10, 200, 12, 60, 30, 140),
    ]
    assert all(len(x) == 0 for x in passages._merged(*(x[:0] for x in columns)))


def test_a_word_said_over_and_over(spark):
    """Documents that repeat one word, or one line, have few ranges for its signatures, and are found."""
    pick = random.Random(31)
    line = words(pick, 12, 10**9)
    texts = {d: " ".join([*words(pick, 60, 10**9), *(["tion"] * 200 if d % 2 else line * 20), *words(pick, 60, 10**9)]) for d in range(8)}
    found = passages.windows(spark.createDataFrame(list(texts.items()), "doc long, text string"))
    rows = passages.cells(found).groupBy("sig", "doc").count().collect()
    assert rows and max(r["count"] for r in rows) == 1
    got = partners(spark, texts)
    assert all(got.get(d) == set(range(d % 2, 8, 2)) for d in texts)


def test_windows_stay_in_their_documents(spark):
    """Documents of one batch are worked on together; their windows are those of each document alone."""
    pick = random.Random(32)
    texts = [None, "", "a b c d", *(" ".join(words(pick, n, size)) for n in (49, 50, 51, 400, 2, 90) for size in (4, 10**6)), " \n", "é x " * 60]
    rows = [(d, t, "x") for d, t in enumerate(texts)]
    got = {tuple(r) for r in passages.windows(spark.createDataFrame(rows, "doc long, text string, key string").coalesce(1)).collect()}
    want = set()
    for doc, text in enumerate(texts):
        shingles = passages.shingle_hashes((text or "").encode())
        for number in range(passages.HASHES):
            ranks = passages._mixed(shingles, number)
            for centre, first, last in zip(*(x.tolist() for x in passages.compact_windows(ranks, 46))):
                want.add((int(ranks[centre].view(np.int64)), doc, number, centre, first, last))
    assert got == want and want


def test_texts_are_hashed_together_as_alone(monkeypatch):
    texts = [t.encode() for t in ("", "a b", "a b c d e", " a  B c d e f\n", "é x " * 30, "a b c d e", " ", "w " * 50)]
    for line in (1, 20, 1 << 18):
        monkeypatch.setattr(passages, "LINE", line)
        got = passages._shingles_of(texts)
        assert [g.tolist() for g in got] == [passages.shingle_hashes(t).tolist() for t in texts]
    assert passages._shingles_of([]) == []


def test_what_a_step_shuffled_or_wrote_for_itself_goes_with_it(spark, tmp_path, monkeypatch):
    """Files of a step are gone when its rows are written; so the disk holds what is still read, not what all steps made."""
    folders = []

    def folder(session, purpose):
        folders.append(tmp_path / f"{purpose}-{len(folders)}")
        return str(folders[-1])

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().endswith(".data")}

    monkeypatch.setattr(passages, "work_dir", folder)
    before, name = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    rows = spark.createDataFrame([(s, d) for s in range(400) for d in range(1 + s % 3)], "sig long, doc long").repartition(4, "doc")
    with shuffles_freed(spark):
        assert spark.conf.get(name) == "true"
        found = passages._several(rows)
    assert spark.conf.get(name) == setting
    assert sorted((r.sig, r.doc, r.n, r.blocks) for r in found.collect()) == [(s, d, 1 + s % 3, 1) for s in range(400) if s % 3 for d in range(1 + s % 3)]
    assert len(folders) == 3 and [f.joinpath("rows").exists() for f in folders] == [False, False, True]
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before


def test_windows_that_meet_are_found_wherever_they_lie():
    pick = np.random.default_rng(4)
    for size in [0, 1, *range(2, 60)]:
        centre = np.sort(pick.integers(0, 40, size))
        first, last, number = centre - pick.integers(0, 25, size), centre + pick.integers(0, 25, size), pick.integers(0, 4, size)
        want = [
            (a, b)
            for a in range(size)
            for b in range(size)
            if number[a] < number[b] and first[a] <= centre[b] <= last[a] and first[b] <= centre[a] <= last[b]
        ]
        assert sorted(pair for a, b in passages._meeting(number, centre, first, last) for pair in zip(a.tolist(), b.tolist())) == want


def test_ranges_of_one_signature_are_one_in_a_document_of_many_windows(spark):
    """Windows of a line that stands there many times; all of them reach to the end of the document."""
    rows = [(number, 1, number, 50 * line + number, 50 * line, 100_000) for line in range(2000) for number in (0, 1)]
    found = spark.createDataFrame(rows, "key long, doc long, hash int, centre int, first int, last int").coalesce(1)
    assert [(r.start, r.end, r.lo, r.hi) for r in passages.cells(found).collect()] == [(0, 100_001, 0, 99_951)]


def test_stretches_of_equal_texts_are_compared_once(monkeypatch):
    pick, compared, compare = random.Random(21), [], passages._alike
    one = words(pick, 60, 10**9)
    texts = [" ".join([*one[:28], *other, *one[28:]]) for other in (words(pick, 20, 10**9), words(pick, 20, 10**9))]

    def counted(*asked):
        compared.append(asked)
        return compare(*asked)

    monkeypatch.setattr(passages, "_alike", counted)
    sizes = [len(passages.shingle_hashes(text.encode())) for text in texts]
    ranges = {"doc": range(20), "block": [0] * 20, "start": [0] * 20, "end": sizes * 10}
    ranges |= {"lo": [0] * 20, "hi": [0] * 20, "left": [0] * 20, "right": sizes * 10}
    links, firsts = passages._linked({**{k: np.array(v) for k, v in ranges.items()}, "words": [t.encode() for t in texts] * 10}, False, 46, 0.8)
    assert firsts == [0, 1] and len(links) == 18 and len(compared) == 4


def test_the_longest_stretch_of_few_runs_and_of_many(monkeypatch):
    pick = np.random.default_rng(6)
    for size in range(120):
        held = pick.random(size) < pick.random()
        few = [passages._longest(held, cost) for cost in (4, 8)]
        with monkeypatch.context() as patch:
            patch.setattr(passages, "FEW_RUNS", 0)
            assert [passages._longest(held, cost) for cost in (4, 8)] == few


def test_a_line_too_short_for_a_passage_is_not_compared_for_every_two(monkeypatch):
    """Forty documents share 47 words and two of them 60; what is found doesn't depend on how the others are ruled out."""
    pick, compared, compare = random.Random(22), [], passages._alike
    line, more = words(pick, 47, 10**9), words(pick, 13, 10**9)
    texts = [" ".join([*line, *(more if number in (5, 30) else []), *words(pick, 20, 10**9)]).encode() for number in range(40)]
    sizes = [len(passages.shingle_hashes(text)) for text in texts]
    rows = {name: np.array([0] * 40) for name in ("block", "start", "lo", "hi", "left")}
    rows |= {"doc": np.arange(40), "end": np.array(sizes), "right": np.array(sizes), "words": texts}
    monkeypatch.setattr(passages, "_alike", lambda *asked: compared.append(1) or compare(*asked))
    found = []
    for failed in (-1, passages.FAILED, 10**9):
        monkeypatch.setattr(passages, "FAILED", failed)
        compared.clear()
        found.append(passages._linked(rows, False, 46, 0.8))
        assert len(compared) == (780 if failed == 10**9 else 1 if failed < 0 else 122)
    assert found[0] == found[1] == found[2] and [(x[0], x[3]) for x in found[0][0]] == [(30, 5)]
