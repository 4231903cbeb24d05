"""Operators 2, 3 and 7 against plain Python over small tables."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from coursewise.llm import exact_dedup, line_dedup, simhash
from coursewise.llm.components import components


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


ROWS = [(1, "Same Text", "en", "a"), (2, "same text", "en", "b"), (9, "SAME TEXT", None, None), (9, "SAME TEXT", None, None), (None, "same text", None, "c"),
        (4, "", None, None), (5, None, None, None), (6, "ÉTÉ", None, None), (7, "été", None, None), (8, "ÉTé", None, None), (None, "alone", None, None),
        (None, "twins", None, None), (None, "twins", None, None), (12, "x" * 200_000, None, None), (13, "X" * 200_000, None, None)]


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates(make_docs, keep, weak):
    digest = (lambda c: F.substring(F.md5(c.cast("binary")), 1, 1)) if weak else exact_dedup.content_hash
    got = sorted(map(tuple, exact_dedup.exact_duplicates(make_docs(ROWS), keep=keep, digest=digest).collect()), key=repr)
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault(lower_ascii(t), []).append(i)
    want = []
    for i, t, *_ in ROWS:
        ids = groups[lower_ascii(t)]
        best = {"min": min, "max": max}[keep]([x for x in ids if x is not None], default=None)
        want.append((i, best, len(ids), i == best, hashlib.sha256(lower_ascii(t).encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_exact_duplicates_of_nothing(make_docs):
    assert exact_dedup.exact_duplicates(make_docs([])).count() == 0


def test_exact_duplicates_run_no_python(spark, make_docs):
    plan = exact_dedup.exact_duplicates(make_docs(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


BLANKS = " \t\r\x0b\x0c"


def plain_strip(rows, min_sites):
    """Lines on so many sites, and still on so many if the rows of a text count as one site: the one with the fewest texts."""
    wide, own = {}, {}
    for _, t, _, s in rows:
        for line in (t or "").split("\n"):
            if line.strip(BLANKS):
                wide.setdefault(line.strip(BLANKS), set()).add(s or "")
    wide = {line for line, sites in wide.items() if len(sites) >= min_sites}
    holds = {t: {p.strip(BLANKS) for p in t.split("\n")} & wide for _, t, _, _ in rows if t is not None}
    pairs = {(t, s or "") for _, t, _, s in rows if t is not None and holds[t]}
    texts_of = {}
    for _, s in pairs:
        texts_of[s] = texts_of.get(s, 0) + 1
    chosen = {}
    for t, s in pairs:
        chosen[t] = min(chosen.get(t, (texts_of[s], s)), (texts_of[s], s))
    for t, (_, s) in chosen.items():
        for line in holds[t]:
            own.setdefault(line, set()).add(s)
    cut = {line for line, sites in own.items() if len(sites) >= min_sites}
    out = []
    for i, t, _, _ in rows:
        parts = [] if t is None else t.split("\n")
        kept = [p for p in parts if p.strip(BLANKS) not in cut]
        out.append((i, t if len(kept) == len(parts) else "\n".join(kept), len(parts) - len(kept)))
    return sorted(out, key=repr)


def test_boilerplate_lines(make_docs):
    rng = random.Random(5)
    frames = [f"frame {k} " + "w" * k for k in range(6)]
    rows = []
    for i in range(120):
        own = [f"own line {i} {j} " + "text " * rng.randint(1, 9) for j in range(rng.randint(0, 6))]
        for k, frame in enumerate(frames):
            if rng.random() < 0.3:
                own.insert(rng.randint(0, len(own)), rng.choice([f" {frame} ", f"{frame}\r", f"\t{frame}", frame]))
        rows.append((i, "\n".join(own), "en", f"s{rng.randint(0, 3 + 2 * (i % 6))}"))
    rows += [(None, "frame 1 w\nnull id and quite some text of its own", None, None), (500, None, None, "s1"), (501, "", None, "s1"), (502, "\n\n \n", None, "s1"),
             (3, rows[3][1], "en", rows[3][3]), (3, "another text under the id", "en", "s2"), (700, "frame 0 \n" + "\n".join(f"l{k}" for k in range(30_000)), None, "s9")]
    rows += [(800 + i, "copied text\nof two lines\r", "en", f"s{i}") for i in range(12)] + [(820 + i, "frame 5 wwwww\r\n\r", "en", f"s{i}") for i in range(12)]
    rows += [(840 + i, f"short {i}\na notice that is longer than the text above it", "en", f"s{i}") for i in range(12)]
    for min_sites in (1, 4, 8):
        got = line_dedup.remove_boilerplate(make_docs(rows), min_sites=min_sites)
        assert [c for c in got.columns if c != "lines_removed"] == [c for c in make_docs(rows[:1]).columns if c != "lines_removed"]
        found = sorted(map(tuple, got.select("doc_id", "text", "lines_removed").collect()), key=repr)
        assert found == plain_strip(rows, min_sites)
    assert line_dedup.remove_boilerplate(make_docs([])).count() == 0


def test_spread_far_from_the_threshold_needs_no_exact_count(spark):
    lines = spark.range(3000).select((F.col("id") % 3).cast("string").cast("binary").alias("hash"), (F.col("id") % (1 + 499 * (F.col("id") % 3 == 0).cast("int"))).cast("string").alias("site"))
    got = {bytes(r["hash"]) for r in line_dedup.boilerplate_lines(lines, 100).collect()}
    assert got == {b"0"}


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    texts = [None, "", " \t\n\x0b\x0c\r", "One", "one TWO", "a b c", "É é x y z w", "lorem ipsum dolor sit " * 200]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "BLOCK_CHARS", 800)
    assert simhash.fingerprint(texts[-1]) == plain_fingerprint(texts[-1])


def test_every_word_has_its_codeword_among_its_neighbours_keys():
    own, flat, offset = simhash.golay_keys()
    near = [set(flat[a:b].tolist()) for a, b in zip(offset[:-1], offset[1:])]
    assert own.min() >= 0 and own.max() < 4096 and max(map(len, near)) <= 6
    for word in range(0, 1 << 16, 7):
        assert int(own[word]) in near[word]
        assert all(int(own[word ^ (1 << b)]) in near[word] for b in range(16))


def test_links_lose_no_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60)
    fps = set(base.tolist())
    for f in base.tolist():
        for _ in range(12):
            x = f
            for b in rng.choice(64, rng.integers(1, 6), replace=False).tolist():
                x ^= 1 << b
            fps.add(x - (1 << 64) if x >= 1 << 63 else x)
    fps |= {0, 1, 3, -1}
    frame = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    for most in (0, 1, 3):
        got = {tuple(r) for r in simhash.links(frame, most).collect()}
        order = sorted(fps)
        assert got == {(a, b) for i, a in enumerate(order) for b in order[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= most}
    with pytest.raises(ValueError):
        simhash.links(frame, 4)


def plain_roots(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(k, k + 1) for k in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 40)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    rng.shuffle(pairs)
    frame = spark.createDataFrame(pairs + pairs[:9] + [(5, 5), (None, 3)], "x bigint, y bigint")
    want = {k: v for k, v in plain_roots([p for p in pairs if p[0] != p[1]]).items()}
    assert {r["node"]: r["root"] for r in components(frame).collect()} == want
    assert components(frame.limit(0)).count() == 0


def test_near_duplicates(make_docs):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(40):
        text = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        rows.append((100 - i, " ".join(text), None, None))
        for j in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((1000 + 10 * i + j, " ".join(text).upper(), None, None))
    rows += [(None, rows[0][1], None, None), (None, "only a null id here", None, None), (7, "", None, None), (3, None, None, None), (rows[1][0], rows[1][1], None, None)]
    got = sorted(map(tuple, simhash.near_duplicates(make_docs(rows)).collect()), key=repr)
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    roots = plain_roots([(a, b) for a in range(len(rows)) for b in range(a, len(rows)) if (fps[a] ^ fps[b]).bit_count() <= 3])
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[roots[k]] = min(i, least.get(roots[k], i))
    want = [(i, f - (1 << 64) if f >> 63 else f, least.get(roots[k])) for k, ((i, *_), f) in enumerate(zip(rows, fps))]
    assert got == sorted(want, key=repr)
    assert simhash.near_duplicates(make_docs([])).count() == 0
