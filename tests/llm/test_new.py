"""Collocations, near duplicates by HyperMinHash and conversation repair against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from doctables.llm import collocations, hyperminhash, repair, wordarrays

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def test_words_of():
    texts = [None, "", "A b,c", "Été x y", " \t", "one\ntwo . ", "d"]
    got = wordarrays.words_of(pa.array([None if t is None else t.encode() for t in texts], pa.binary()), collocations.PIECES)
    want = [(i, p, w.encode()) for i, t in enumerate(texts) for p, s in enumerate(re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER))) for w in re.findall(r"[^\x20\x09]+", s)]
    assert [(r, got.known[o]) for r, o in zip(got.row.tolist(), got.of.tolist())] == [(i, w) for i, _, w in want]
    pieces = [x[:2] for x in want]
    same = [a == b for a, b in zip(pieces, pieces[1:])]
    assert [a == b for a, b in zip(got.piece.tolist(), got.piece.tolist()[1:])] == same
    assert len(wordarrays.words_of(pa.array([], pa.binary())).of) == 0


def brute_collocations(rows, least, longest, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und", tuple(w[i : i + k])] += 1
    out = {}
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    for (lang, p), a in cand.items():
        inside = any(g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and b >= a for (g, q), b in cand.items())
        if not inside:
            score, k = min((int(Fraction(1000 * a * n[lang], f[lang, p[:k]] * f[lang, p[k:]])), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return {(lang, i + 1, x[2].decode(), *x[3:]) for lang, found in out.items() for i, x in enumerate(sorted(found)[:top])}


def test_collocations(spark, make_docs, odd_docs):
    rng = random.Random(3)
    some = ["a", "b", "c", "New", "york", "été", "x y", "d.", "e,", "f\n"]
    rows = [(i, " ".join(rng.choices(some, [9, 8, 7, 5, 5, 2, 2, 2, 1, 1], k=rng.randint(0, 60))), rng.choice(["en", "en", "fr", None])) for i in range(60)]
    rows += [(100, None, "en"), (101, "", "xx"), (102, "a b c new york a b", "de"), *[(103, "same words here again", "fr")] * 4]
    for least, longest, top in ((4, 5, 2000), (2, 3, 7), (1, 2, 50)):
        got = {tuple(r) for r in collocations.collocations(make_docs(rows), least, longest, top).collect()}
        assert got == brute_collocations([(r[2], r[1]) for r in rows], least, longest, top)
    assert collocations.collocations(odd_docs.limit(0), 2).count() == 0
    got = {tuple(r) for r in collocations.collocations(odd_docs, 3).collect()}
    assert got == brute_collocations([(r.lang, r.text) for r in odd_docs.collect()], 3, 5, 2000)


def test_collocations_beyond_64_bits(spark, monkeypatch):
    counts = [("en", ["a"], 4 * 10**9), ("en", ["b"], 3 * 10**9), ("en", ["a", "b"], 2 * 10**9)]
    known = spark.createDataFrame(counts, "lang string, words array<string>, a long")
    total = spark.createDataFrame([("en", 7 * 10**18)], "lang string, n long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *a: (known, total))
    (row,) = collocations.collocations(known).collect()
    assert row.score == 1000 * 2 * 10**9 * 7 * 10**18 // (12 * 10**18)


def sets_by_row(rows, k=3):
    out = []
    for i, t in rows:
        w = plain_words(t)
        out.append((i, frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    return out


def brute_near(rows):
    found = sets_by_row(rows)
    parent = {i: i for i, _ in found if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in found:
        for j, b in found:
            if i is not None and j is not None and i < j and a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    least = {}
    for i in parent:
        least[root(i)] = min(least.get(root(i), i), i)
    return sorted(((i, len(s), None if i is None else least[root(i)]) for i, s in found), key=str)


@pytest.mark.parametrize("stretch", [hyperminhash.STRETCH, 2])
def test_near_duplicates(make_docs, odd_docs, stretch):
    rng = random.Random(5)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] if stretch > 2 else []
    base = [f"w{rng.randrange(500)}" for _ in range(90)]
    for i in range(100, 150):  # copies of one text with 0 to 4 words changed: many links, some only by way of others
        t = list(base)
        for _ in range(rng.randrange(5)):
            t[rng.randrange(90)] = f"x{rng.randrange(99)}"
        rows.append((i, " ".join(t)))
    rows += [(200 + i, " ".join(f"v{i * 3 + j}" for j in range(40))) for i in range(12)]  # a chain of shifts
    rows += [(300, "p q r s t u v w"), (301, "p q r s t u v w x"), (302, "P q r s t u v w")]
    docs = make_docs(rows)
    got = hyperminhash.near_duplicates(docs, stretch=stretch).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_near(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    if stretch > 2:
        assert hyperminhash.near_duplicates(docs.limit(0)).count() == 0
        again = rows[-3:] + [(301, "other text of this id"), (400, "other text of this id"), (None, "p q r s t u v w")]
        got = hyperminhash.near_duplicates(make_docs(again)).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_near(again)


def test_registers_and_bitmaps():
    rng = np.random.default_rng(1)
    texts = [b"", b"a", b"a b", b"a b c", b"A b c a b c a", " ".join(map(str, rng.integers(0, 50, 3000))).encode()]
    hashes, ends = hyperminhash.shingle_sets(pa.array(texts, pa.binary()))
    assert np.diff(np.append(0, ends)).tolist() == [len(s) for _, s in sets_by_row([(0, t.decode()) for t in texts])]
    regs = hyperminhash.registers(hashes, ends)
    for r, a, e in zip(regs, [0, *ends[:-1]], ends):
        want = np.zeros(256, np.uint16)
        for h in hashes[a:e].tolist():  # register by its bits, one hash at a time
            rest = (h & ((1 << 56) - 1)) >> 3
            zeros = 53 - rest.bit_length()
            value = ((zeros + 1) << 10) | ((rest << (zeros + 1) & ((1 << 53) - 1)) >> 43)
            old = want[h >> 56]
            # a smaller rest has more zeros or, with as many, a smaller mantissa
            if not old or (zeros + 1, -(value & 1023)) > (int(old) >> 10, -(int(old) & 1023)):
                want[h >> 56] = value
        assert (r == want).all()
    n = 2000
    both = rng.integers(0, 1 << 64, n, dtype=np.uint64, endpoint=False)
    for share in (0.95, 0.86, 0.5, 0.1):
        kept = int(n * share)
        x, y = np.unique(both[:n]), np.unique(np.append(both[:kept], rng.integers(0, 1 << 64, n - kept, dtype=np.uint64)))
        a, b = (hyperminhash.registers(s, np.array([len(s)])) for s in (x, y))
        both_n = len(np.intersect1d(x, y))
        true = both_n / (len(x) + len(y) - both_n)
        may = hyperminhash.plausible(a, b, np.array([len(x)]), np.array([len(y)]), (85, 100))[0]
        assert may or true < 0.85
        assert not (may and true < 0.6)
        if 100 * both_n >= 85 * (len(x) + len(y) - both_n):
            assert hyperminhash.may_link(hyperminhash.parity(x)[None, :], hyperminhash.parity(y), len(x), len(y), (85, 100))[0]
    # disjoint sets agree by chance as often as the correction says
    agree = []
    for _ in range(300):
        a, b = (hyperminhash.registers(np.unique(rng.integers(0, 1 << 64, 4096, dtype=np.uint64)), np.array([4096])) for _ in range(2))
        agree.append(((a == b) & (a != 0)).sum() / 256)
    assert abs(np.mean(agree) - hyperminhash._chance(48)) < 5 * np.std(agree) / 300**0.5 + 1e-5


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        word = lambda v: " " if v is None else str(v)
        hit = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def brute_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of one conversation's rows, states carried with whole texts."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, fault = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    goes = {"": "su", "s": "u", "u": "a", "a": "u"}
    ways = {"": (0, "", ())}

    def insert(ways):
        for _ in range(2):
            for state, (c, a, o) in list(ways.items()):
                for r in goes[state].replace("s", ""):
                    new = (c + 3, a + "I", (*o, {"u": "user", "a": "assistant"}[r] + ":"))
                    ways[r] = min(ways.get(r, new), new)
        return ways

    for (_, _, role, text), why in zip(rows, fault):
        new = {}
        for state, (c, a, o) in insert(ways).items():
            found = [(state, (c + 4, a + "D", o))]
            if why not in ("blank", "duplicate"):
                more = 3 if why == "truncated" else 0
                if role[:1] and role[:1] in goes[state]:
                    found.append((role[:1], (c + more, a + "K", (*o, f"{role}:{text}"))))
                for r in goes[state].replace("s", ""):
                    found.append((r, (c + 3 + more, a + "R", (*o, {"u": "user", "a": "assistant"}[r] + ":" + text))))
            for s, w in found:
                new[s] = min(new.get(s, w), w)
        ways = new
    cost, audit, out = min(w for s, w in insert(ways).items() if s in ("", "a"))
    said = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(fault.count(x) for x in ("blank", "duplicate", "truncated")),
        sum(x + y not in ("su", "ua", "au") for x, y in zip(said, said[1:])), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


TALK = "conv_id long, turn long, role string, text string, part string, pos string, cost string"


def talk(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TALK)


def check_repair(spark, rows, damage, stretch):
    conversations = talk(spark, rows)
    hit = repair.damaged(conversations) if damage else conversations
    got = {r.conv_id: tuple(r)[1:] for r in repair.report(conversations, hit, stretch).collect()}
    after = brute_damage(rows) if damage else rows
    assert got == {c: brute_repair([r for r in after if r[0] == c]) for c in {r[0] for r in rows}}


@pytest.mark.parametrize("stretch", [3, repair.STRETCH])
def test_repair(spark, stretch):
    rng = random.Random(stretch)
    say = ["Hello.", "Well!", "no end", "Why?", "", " \n", "Yes. ", "same."]
    rows = []
    for conv in range(60):
        for turn in range(rng.choice([1, 2, 3, 6, 12])):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), rng.choice(say) + rng.choice(["", str(turn) + "."])))
    rows += [(1000, i, rng.choice(["user", "assistant"]), f"line {i}" + rng.choice(".! ")) for i in range(400)]  # one long conversation over many tasks
    rows += [(None, 1, "user", "hi."), (None, None, "assistant", "there")]
    check_repair(spark, rows, False, stretch)


def test_repair_of_damage(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["Fine.", "so so", None, "Really? Yes!"]) ) for c in range(80) for t in range(rng.randint(1, 9))]
    rows += [(None, None, None, None), (500, None, "user", "a."), (500, None, "user", "a."), *[(501, 3, "user", "again.")] * 30]
    check_repair(spark, rows, True, 4)
    assert repair.report(talk(spark, []), repair.damaged(talk(spark, []))).count() == 0


def test_row_edits_are_cheapest():
    for initial in range(4):
        for fault in (repair.CLEAN, repair.CUT, repair.GONE):
            for before, row in enumerate(repair.edits(initial, fault)):
                assert row[before] is not None  # deletion is always a way
                assert not any(a and a.count("I") > 2 for a in row)
