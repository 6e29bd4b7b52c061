"""Phrase fingerprints, filter audit and token alignment against brute force, and the rows that are hard to take."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cropweave.llm import alignment, audit, phrases

FOLDER = "/root/testdata/sf0.001"


def brute_phrases(data):
    """The phrase set as text: the longest known phrase and one byte more, until the text ends."""
    known, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in known:
            known.add(data[start:end])
            start = end
    return known


@pytest.mark.parametrize("text", ["", "a", "aaaaaaa", "abababab", "to be or not to be", "é日本日本" * 20, "x" * 5000])
def test_phrases_are_those_of_the_definition(text):
    data = text.encode()
    assert len(phrases.Parse().feed(data).phrases()) == len(brute_phrases(data))
    begun = phrases.Parse().feed(data[:len(data) // 3])
    rest = phrases.Parse(begun).feed(data[len(data) // 3:])
    assert rest.hashes == phrases.Parse().feed(data).hashes


def test_hashes_stand_for_phrases():
    """Equal phrases of different texts have equal hashes, different ones different hashes."""
    texts = [b"the cat sat on the mat", b"the dog sat on the log", b"tttthe the the"]
    by_set = Counter(p for t in texts for p in brute_phrases(t))
    by_hash = Counter(h for t in texts for h in phrases.Parse().feed(t).phrases().tolist())
    assert sorted(by_set.values()) == sorted(by_hash.values())


def test_likeness_estimates_the_jaccard_of_phrases():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    for share in (0.0, 0.3, 0.7, 1.0):
        a = " ".join(rng.choices(words, k=900)).encode()
        b = a[:int(len(a) * share)] + " ".join(rng.choices(words, k=900)).encode()[:int(len(a) * (1 - share))]
        one, two = brute_phrases(a), brute_phrases(b)
        exact = len(one & two) / len(one | two)
        got = phrases.likeness(phrases.Parse().feed(a).fingerprint(), phrases.Parse().feed(b).fingerprint())
        assert abs(got - exact) < 0.15
    small = [phrases.Parse().feed(t).fingerprint() for t in (b"abcabc", b"abcxyz")]
    assert phrases.likeness(*small) == 3 / 7  # exact while both sets fit: a b c ab, of c is last; x y z
    assert phrases.likeness(small[0], small[0]) == 1 and phrases.likeness(small[0], small[0][:0]) == 0


def brute_edited(rows):
    """Counter of (doc_id, n_chars, hash of the edited text), rows with an id only."""
    ring = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: (-r[0], r[1].encode()))
    out = Counter()
    for k, (i, text) in enumerate(ring):
        following = ring[(k + 1) % len(ring)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        out[i, len(text), hashlib.sha256(edited.encode()).hexdigest(),
            phrases.written(phrases.Parse().feed(edited.encode()).fingerprint()),
            phrases.likeness(*[phrases.Parse().feed(t.encode()).fingerprint() for t in (text, following)])] += 1
    return out


def edited_rows(frame):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, r.edited_fingerprint, r.near_next)
                   for r in phrases.edited_pairs(frame).collect() if r.doc_id is not None)


@pytest.mark.parametrize("ranges", ["1", "4", "13"])
def test_edited_texts_whatever_the_ranges(shared, documents, ranges):
    before = shared.conf.get("spark.sql.shuffle.partitions")
    shared.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
        assert edited_rows(documents) == brute_edited(rows)
        single = documents.where("doc_id = 7")
        assert edited_rows(single) == brute_edited([(r.doc_id, r.text) for r in single.collect()])
    finally:
        shared.conf.set("spark.sql.shuffle.partitions", before)


def test_fingerprints_of_the_query(shared):
    from cropweave.llm import QUERIES

    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = QUERIES["op11_lz_fingerprint"](shared, FOLDER).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.edited_fingerprint, r.near_next) for r in got) == brute_edited(
        [(r["doc_id"], r["text"]) for r in table])
    texts = {r["doc_id"]: r["text"] or "" for r in table}
    for r in got:
        assert r.fingerprint == phrases.written(phrases.Parse().feed(texts[r.doc_id].encode()).fingerprint())
        assert r.near_edited == phrases.likeness(phrases.read(r.fingerprint), phrases.read(r.edited_fingerprint))


def test_fingerprints_hard_rows(documents, no_documents):
    got = phrases.edited_pairs(documents).collect()
    assert len(got) == documents.count()
    loose = [r for r in got if r.doc_id is None]
    assert len(loose) == 2 and all(r.near_next is None for r in loose)
    by_text = defaultdict(set)
    for r in phrases.fingerprints(documents).collect():
        by_text[r.doc_id].add(r.fingerprint)
    assert by_text[1] == by_text[2] != by_text[3] and by_text[4] == by_text[5] == {""}
    assert phrases.edited_pairs(no_documents).collect() == []


def brute_audit(rows, good, toxic):
    """The report by walking every order, document by document."""
    lowest = {}
    for i, t, _ in rows:
        if i is not None:
            lowest[t or ""] = min(i, lowest.get(t or "", i))
    failed = []
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {k for k, bad in {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > lowest[t]}.items() if bad}
        failed.append((lang or "", i, fails))
    out = {}
    for part in {p for p, _, _ in failed}:
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = [(i, f) for p, i, f in failed if p == part]
            everyone = alive
            for step, own in enumerate(order, 1):
                gone = [(i, f) for i, f in alive if own in f]
                redundant = sum(own in f for _, f in everyone) - len(gone)
                alive = [(i, f) for i, f in alive if own not in f]
                shapley[own] += len(gone)
                out[part, order, step] = [len(alive), len(gone), redundant, sum(f == {own} for _, f in everyone),
                                          sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_against_every_walk(shared, documents):
    rng = random.Random(5)
    rows = [(r.doc_id, r.text, r.lang) for r in documents.select("doc_id", "text", "lang").collect()]
    for i in range(100, 260):
        words = [rng.choice(["alpha", "BETA", "g#", "delta", f"w{j}"]) for j in range(rng.choice([3, 90, 101, 150]))]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words), rng.choice(["en", "fr", None, "", "xx"])))
    rows += [(i + 500, t, rng.choice(["en", "de"])) for i, t, _ in rows[-60:] for _ in range(2)]
    marks = [(i, int(rng.random() < 0.5), int(rng.random() < 0.3)) for i in range(0, 800, 2)] + [
        (8, 1, 0), (8, 0, 1), (None, 1, 1), (101, None, None)]
    labels = shared.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "'own' AS good")
    frame = shared.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "*", "1 AS part", "2 AS bits", "3 AS quality", "4 AS digest", "5 AS n", "6 AS body")
    got = audit.audit(frame, labels).collect()
    want = brute_audit(rows, {i for i, q, _ in marks if q and i is not None}, {i for i, _, x in marks if x and i is not None})
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == want and len(got) == len(want)


def test_audit_of_nothing(no_documents, shared):
    labels = shared.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(no_documents, labels).collect() == []


def test_contraction_adds_up():
    rng = np.random.default_rng(1)
    tensors = rng.integers(0, 50, (3, 2, 2, 2, 2, 2))
    found = audit.contract(tensors, tensors, tensors)
    last = [k for k, (_, step) in enumerate(audit.steps()) if step == 5]
    assert (found["kept"][:, last] == tensors[:, 0, 0, 0, 0, 0][:, None]).all()
    assert (found["removed"] == found["good_lost"]).all()
    failing = tensors.reshape(3, -1).sum(axis=1) - tensors[:, 0, 0, 0, 0, 0]
    own = {f: next(k for k, (o, s) in enumerate(audit.steps()) if o[s - 1] == f) for f in audit.FILTERS}
    assert (sum(found["shapley"][:, k] for k in own.values()) == 120 * failing).all()


@pytest.mark.parametrize("seed", range(30))
def test_shared_ends_are_the_intersection(seed):
    rng = np.random.default_rng(seed)
    total = int(rng.integers(1, 400))
    a, b = (sorted({*rng.choice(total, int(rng.integers(0, total)), replace=False).tolist(), total}) for _ in range(2))
    if seed % 3 == 0:  # long one-to-one stretches with few irregular places
        a = list(range(1, total + 1))
        b = [x for x in a if rng.random() > 0.02 or x == total]
    i, j = alignment.last_tokens(alignment.shared_ends(a, b))
    want, at_a, at_b = np.intersect1d(a, b, return_indices=True)
    assert (np.array(a)[i] == want).all() and (i == at_a).all() and (j == at_b).all()


def brute_alignment(texts):
    first = Tokenizer.from_file(alignment.A_PATH)
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=alignment.B_PATH)
    letters = alignment.byte_letters()
    links, found = Counter(), []
    for text in texts:
        data = b" " + (text or "").encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, second.id_to_piece(i)) for i in b)]
        if not text or b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            found.append(None)
            continue
        ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b))
        groups, pairs, start, place_b = [], [], (0, 0), {end: j for j, end in enumerate(ends_b)}
        for i, end in enumerate(ends_a):
            if end in place_b:
                j = place_b[end]
                groups.append(",".join(map(str, a[start[0]:i + 1])) + "|" + ",".join(map(str, b[start[1]:j + 1])))
                pairs.append((a[i], b[j]))
                start = i + 1, j + 1
        links.update(pairs)
        found.append((len(a), len(b), groups, pairs))
    most = Counter()
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (
        f[0], f[1], len(f[2]), len(f[3]), sum(links[p] == most[p[1]] for p in f[3]), sum(links[p] for p in f[3]),
        hashlib.sha256(";".join(f[2]).encode()).hexdigest()) for f in found]


TEXTS = ["Hello world, this is a test.", "  two  blanks\n\nand lines\t\ttabs ", "日本語 😀😀 é ü ß ﬁ ①", "<s> <unk> <|endoftext|> </s>",
         "a▁b", "", None, " ", "▁", "x", "can't won't I'll", "NULL\x00byte \x07", "a" * 300, "word " * 400,
         "Hello world, this is a test."]


def aligned_rows(frame):
    return Counter(tuple(r) for r in alignment.alignment(frame).collect())


def test_alignment_against_brute_force(shared):
    frame = shared.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = brute_alignment(TEXTS)
    assert aligned_rows(frame) == Counter((i, *row) for i, row in enumerate(want))


def test_alignment_over_many_chunks(shared, documents, no_documents, monkeypatch):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect() if r.doc_id != 7]
    frame = documents.where("doc_id <> 7 OR doc_id IS NULL")
    want = Counter((i, *row) for (i, _), row in zip(rows, brute_alignment([t for _, t in rows])))
    assert aligned_rows(frame) == want
    assert aligned_rows(frame.repartition(5)) == want
    assert aligned_rows(documents).total() == documents.count()
    assert aligned_rows(no_documents) == Counter()


def test_places_of_large_chunks_take_four_bytes():
    n = (1 << 16) + 5
    documents = alignment.pa.table({
        "chunk": ["c"], "doc_id": [1], "n_a": [2], "n_b": [2], "n_groups": [2], "groups_sha256": ["x"],
        "links": [np.array([0, n - 1], np.uint32).tobytes()]})
    totals = alignment.pa.table({"of_chunk": ["c"] * n, "pair": np.arange(n)[::-1], "n": np.arange(n)[::-1], "best": [True] * n})
    assert alignment._scored(documents, totals).to_pylist()[0]["count_sum"] == n - 1


def test_alignment_query_over_its_table(shared):
    from cropweave.llm import QUERIES

    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = brute_alignment([r["text"] for r in table])
    got = Counter(tuple(r) for r in QUERIES["op13_token_alignment"](shared, FOLDER).collect())
    assert got == Counter((r["doc_id"], *row) for r, row in zip(table, want))
