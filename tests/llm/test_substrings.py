import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import documents, sentence

from tarnlab.llm import substrings as sub


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted({r for r in rows if r[0] is not None and r[1]}):
        content = text.encode()
        edges = sub.cuts(content).tolist()
        copied = []
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            c = content[a:b].strip()
            if c in seen:
                copied.append(k)
            seen.add(c)
        spans = sub.removed_spans(content, edges, copied)
        last, kept = 0, b""
        for a, b in spans:
            kept, last = kept + content[last:a], b
        out[i] = (kept + content[last:]).decode(), len(edges) - 1, sum(any(x <= a and b <= y for x, y in spans) for a, b in zip(edges, edges[1:], strict=False)), [list(s) for s in spans]
    return out


def test_documents(docs):
    got = sub.dedup_substrings(docs, carry=("row", "key", "lang")).collect()
    assert {(r.row, r.key) for r in got} == {("x3", "x4")}
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in documents())
    expected = brute(documents())
    for r in got:
        if r.doc_id in expected:
            assert (r.text, r.n_chunks, r.n_copied, r.spans) == expected[r.doc_id], r.doc_id
    by = {r.doc_id: r for r in got}
    assert (by[12].text, by[13].text, by[14].text) == (None, "", " \n\t ")
    assert by[2].removed_bytes == 0 and by[10].text == ""
    assert by[20].removed_bytes == 0 and by[21].removed_bytes > 0


def test_passages_over_fifty_words_stay_once(spark):
    rng = random.Random(11)
    passages = [sentence(rng, rng.randrange(51, 90)) + f" mark{p}" for p in range(20)]
    rows = [(i, " ".join([sentence(rng, rng.randrange(0, 60)) + f" own{i}", passages[i % 20], sentence(rng, rng.randrange(0, 60))])) for i in range(200)]
    got = {r.doc_id: r.text for r in sub.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for p in passages:
        assert sum(p in t for t in got.values()) == 1
    assert all(f"own{i} " in t + " " for i, t in got.items())


def test_clean_documents_stay(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(100)) + " the same common line of few words") for i in range(50)]
    got = {r.doc_id: r.text for r in sub.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(rows)


def test_cuts_resist_insertions():
    rng = random.Random(13)
    a = sentence(rng, 2000).encode()
    b = a[:500] + b"inserted words here " + a[500:]
    chunks = lambda c: Counter(c[x:y] for x, y in zip(sub.cuts(c).tolist(), sub.cuts(c).tolist()[1:], strict=False))
    assert sum((chunks(a) - chunks(b)).values()) <= 4


@pytest.mark.parametrize("content", [b"", b"a", "日本語".encode() * 900, b"a" * 9000, b" " * 3000, b"ab cd " * 700, bytes(range(1, 128)) * 40])
def test_cuts_cover_the_text(content):
    c = sub.cuts(content)
    assert c[0] == 0 and c[-1] == len(content)
    assert (np.diff(c) > 0).all() and (np.diff(c) <= 2 * sub.MAX_BYTES).all()
    for a, b in zip(c, c[1:], strict=False):
        content[a:b].decode()


def test_cuts_restated():
    """The cutting rule, a byte at a time."""
    raw = hashlib.shake_128(b"gear").digest(512)
    share = [raw[2 * b] | raw[2 * b + 1] << 8 for b in range(256)]
    rng, blank = random.Random(17), b" \t\n\v\f\r"
    for _ in range(200):
        content = "".join(rng.choice(["wort", "é", "a", "longer", "x1"]) + rng.choice([" ", " ", "\n", "  \t", ""]) for _ in range(rng.randrange(200))).encode()
        x, out = 0, [0]
        for i in range(len(content) - 1):
            x = (2 * x + share[content[i]]) % 65536
            begins = content[i] in blank and content[i + 1] not in blank
            if begins and x & 0x6000 == 0 and i + 1 - out[-1] >= 12:
                out.append(i + 1)
        if len(out) > 1 and len(content) - out[-1] < 12:
            out.pop()
        out += [len(content)] if content else []
        if all(b - a <= 512 for a, b in zip(out, out[1:], strict=False)):
            assert sub.cuts(content).tolist() == out


def test_gear_rolls():
    data = np.frombuffer(b"the quick brown fox jumps over the lazy dog", np.uint8)
    h, want = sub.gear(data), []
    x = 0
    for b in data:
        x = (x * 2 + int(sub._GEAR[b])) & 0xFFFF
        want.append(x)
    assert h.tolist() == want


def test_empty(no_docs):
    assert sub.dedup_substrings(no_docs).count() == 0


def test_phrases_from_different_places_stay(spark):
    """Clean documents stitched from common short phrases; only passages that stand so in one earlier text go."""
    rng = random.Random(14)
    phrases = [" ".join(f"p{k}x{rng.randrange(10**6)}" for _ in range(16)) for k in range(41)]
    own = lambda: " ".join(f"w{rng.randrange(10**9)}" for _ in range(30))
    rows = [(i, f"{own()} {p} {own()}") for i, p in enumerate(phrases)]
    rows += [(100 + i, " ".join([own(), *(phrases[(7 * i + k * (i + 2)) % 41] for k in range(6)), own()])) for i in range(20)]
    mixed = [f"{own()} {' '.join(phrases[:3])} {own()} {' '.join(phrases[3:6])}"]
    mixed.append(f"{mixed[0]} {own()} {phrases[2]} {phrases[0]} {phrases[4]} {own()}")  # within one text too
    rows.append((200, mixed[1]))
    repeated = " ".join(phrases[30 * k % 41] for k in range(5))
    rows += [(300, f"{own()} {repeated} {own()}"), (301, f"{own()} {repeated} {phrases[39]} {own()}")]
    got = {r.doc_id: r for r in sub.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got[i].text for i, _ in rows if i < 301} == {i: t for i, t in rows if i < 301}
    assert got[100].n_copied == 0  # copied chunks whose neighbours are others than before
    gone = [rows[-1][1].encode()[a:b].decode().strip() for a, b in got[301].spans]
    assert len(gone) == 1 and gone[0] in repeated and len(gone[0].split()) > 60


def fifths(text):
    """What each byte of a text counts: five where a word starts, one for its characters after the thirtieth; and whether it is inside a word."""
    units, inside, nth = [], [], 0
    for c in text:
        nth = 0 if c in " \t\n\x0b\x0c\r" else nth + 1
        units += [5 if nth == 1 else int(nth > 30)] + [0] * (len(c.encode()) - 1)
        inside += [nth > 1] * len(c.encode())
    return units, inside


def plain(rows):
    """Which chunks go, by comparing every run of chunks with 20 words, or as much without spaces, and those before it."""
    seen, out = set(), {}
    for i, text in sorted({r for r in rows if r[0] is not None and r[1]}):
        content = text.encode()
        e = sub.cuts(content).tolist()
        chunks = [content[a:b].strip() for a, b in zip(e, e[1:], strict=False)]
        gone, (units, inside) = set(), fifths(text)
        for a in range(len(chunks)):
            for b in range(a, min(len(chunks), a + 12)):
                if sum(units[e[a] : e[b + 1]]) + 5 * inside[e[a]] >= 100:
                    if (run := tuple(chunks[a : b + 1])) in seen:
                        gone.update(range(a, b + 1))
                    seen.add(run)
        out[i] = [list(s) for s in sub.removed_spans(content, e, sorted(gone))]
    return out


def test_windows_find_all_copied_runs(spark):
    rng = random.Random(15)
    pool = [sentence(rng, rng.randrange(3, 40)) for _ in range(30)] + ["長い文章" * 90, "x" * 700]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(150)]
    got = {r.doc_id: r.spans for r in sub.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain(rows)


def test_different_texts_of_one_id(spark):
    rng = random.Random(16)
    own = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(60)) for _ in range(6)]
    rows = [(1, own[0]), (7, f"{own[1]} {own[0]}"), (7, f"{own[2]} {own[3]}"), (8, f"{own[4]} {own[5]}"), (8, f"{own[5]} {own[4]} more")]
    rows += [rows[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sub.dedup_substrings(df, carry=("text",)).toDF("doc_id", "text", "n_chunks", "n_copied", "removed_bytes", "spans", "source").collect()
    by = {r.source: r for r in got}
    assert len(got) == len(rows) and set(by) == {t for _, t in rows}
    assert by[rows[2][1]].text == rows[2][1] and by[rows[2][1]].n_copied == 0  # of another text of the id
    assert all(own[1] in r.text and own[0] not in r.text and r.removed_bytes > 300 for r in got if r.source == rows[1][1])
    both = sorted(by[t].removed_bytes for _, t in rows[3:5])
    assert both[0] == 0 and both[1] > 600  # copies between texts of one id


def test_unspaced_scripts_count_by_characters(spark):
    """A passage of 800 characters without a space stands in two documents: it goes from the second, but for its edges."""
    rng = random.Random(21)
    text = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    passage, own = text(800), [text(900) for _ in range(4)]
    rows = [(0, own[0] + passage + own[1]), (1, own[2] + passage + own[3]), (2, text(2000)), (3, "kurze Wörter " + own[0][:60])]
    got = {r.doc_id: r for r in sub.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].removed_bytes == got[2].removed_bytes == got[3].removed_bytes == 0
    assert 0.5 * 2400 < got[1].removed_bytes <= 2400 and own[2] in got[1].text and own[3] in got[1].text


def test_a_passage_of_very_many_documents(spark, monkeypatch):
    """Windows of many rows are joined by broadcast, others by shuffle: the result is one."""
    rng = random.Random(22)
    passages = [sentence(rng, 80) for _ in range(3)]
    rows = [(i, sentence(rng, 20) + f" own{i} " + passages[0 if i % 3 else i % 7 % 3]) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain = {r.doc_id: r.text for r in sub.dedup_substrings(df).collect()}
    monkeypatch.setattr(sub.common, "HOT_ROWS", 10)
    monkeypatch.setattr(sub.common, "HOT_KEYS", 4)
    assert {r.doc_id: r.text for r in sub.dedup_substrings(df).collect()} == plain
    assert all(sum(p in t for t in plain.values()) == 1 for p in passages)


def test_measure():
    count = lambda t: sub.measured(t.encode())[0][-1] / sub.CHARS
    assert count("one two  three\n") == 3 and count("x" * 30) == 1 and count("x" * 35) == 2
    assert count("语" * 130) == 21 and count(" ") == 0 and count("a " + "é" * 31) == 2.2
