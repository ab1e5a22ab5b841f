"""Content-defined chunks: resistance to shifts, planted passages, odd rows."""

import random

from conftest_llm import ODD

from llm import chunks

RNG = random.Random(11)
VOCABULARY = ["".join(RNG.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(RNG.randint(2, 9))) for _ in range(5000)]


def _text(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def test_cuts_move_with_the_text():
    body = _text(2000).encode()
    for shift in (b"x", b"two words ", b"\n" * 37):
        own = {body[a:b] for a, b in zip(chunks.cuts(body), chunks.cuts(body)[1:])}
        moved = shift + body
        other = {moved[a:b] for a, b in zip(chunks.cuts(moved), chunks.cuts(moved)[1:])}
        assert len(own - other) <= 2


def test_cuts_cover_any_text():
    for text in ["", "a", "é" * 5000, "x" * 5000, " " * 700, "日本 " * 400, "\n".join(["word"] * 300)]:
        body = text.encode()
        at = chunks.cuts(body)
        assert at[0] == 0 and at[-1] == len(body) and at == sorted(set(at))
        assert "".join(body[a:b].decode() for a, b in zip(at, at[1:])) == text
        assert all(b - a <= chunks.MOST_BYTES + chunks.LEAST_BYTES + 64 for a, b in zip(at, at[1:])) or " " not in text


def test_planted_passages_go_and_clean_texts_stay(make_docs, spark):
    passages = [_text(60) for _ in range(10)]
    rows = [(k, _text(150)) for k in range(40)]
    for k in range(100, 160):
        rows.append((k, f"{_text(40)} {passages[k % 10]} {_text(40)}"))
    got = {r.doc_id: r for r in chunks.dedup(make_docs(rows)).collect()}
    texts = dict(rows)
    for k in range(40):
        assert got[k].text == texts[k] and got[k].removed_bytes == 0
    for k in range(100, 110):
        assert got[k].text == texts[k]
    caught = 0
    for k in range(110, 160):
        left = set(zip(got[k].text.split(), got[k].text.split()[1:], got[k].text.split()[2:]))
        words = passages[k % 10].split()
        rest = sum(w in left for w in zip(words, words[1:], words[2:]))
        caught += rest < 30
        assert 100 + k % 10 in got[k].first_doc_ids and set(got[k].first_doc_ids) <= set(range(100, k))
        assert set(texts[k].split()[:30]) <= set(got[k].text.split())
    assert caught == 50


def test_copies_keep_the_first(make_docs):
    text = _text(300)
    got = {r.doc_id: r for r in chunks.dedup(make_docs([(k, text) for k in (9, 4, 7)])).collect()}
    assert got[4].text == text and got[7].text == "" and got[9].text == "" and got[9].first_doc_ids == [4]


def test_passages_without_spaces_go(make_docs):
    def text(n):
        return "".join(chr(RNG.randrange(0x4E00, 0x9F00)) for _ in range(n))

    passage, copy = text(600), text(500)
    rows = [(k, text(300) + passage + text(300)) for k in range(4)] + [(k, copy) for k in (10, 11)] + [(k, text(400)) for k in (20, 21)]
    got = {r.doc_id: r for r in chunks.dedup(make_docs(rows)).collect()}
    texts = dict(rows)
    for k in (0, 10, 20, 21):
        assert got[k].text == texts[k] and got[k].removed_bytes == 0
    for k in (1, 2, 3):
        assert len(got[k].text) < 800 and got[k].first_doc_ids == [0]
        assert got[k].text.startswith(texts[k][:250]) and got[k].text.endswith(texts[k][-200:])
    assert got[11].text == "" and got[11].first_doc_ids == [10]


def test_odd_rows(make_docs):
    docs = make_docs(ODD)
    out = chunks.dedup(docs)
    assert out.count() == len(ODD) and set(docs.columns) <= set(out.columns)
    assert sorted(repr(r.doc_id) for r in out.collect()) == sorted(repr(d) for d, _ in ODD)
    assert {r.text for r in out.collect() if r.doc_id is None} == {"no id here", None}
    assert chunks.dedup(make_docs([])).collect() == []


def test_result_equals_brute_force(spark, small):
    from llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    owner: dict[int, int] = {}
    for doc_id, text in sorted(docs):
        for digest in chunks.chunks(text.encode())[1]:
            owner.setdefault(digest, doc_id)
    got = {r.doc_id: r for r in QUERIES["op10_chunk_dedup"](spark, small).collect()}
    for doc_id, text in docs:
        foreign = {d: owner[d] for d in chunks.chunks(text.encode())[1] if d and owner[d] < doc_id}
        kept, n, repeated, spans, lenders = chunks.cut_text(text, foreign, chunks.LEAST_WORDS)
        r = got[doc_id]
        assert (r.text, r.n_chunks, r.n_repeated_chunks, list(r.first_doc_ids)) == (kept, n, repeated, lenders)
