"""Runs against a brute-force search, digests, planted repeats and the odd cases."""
import hashlib
import random
import zlib

from webfold.llm.periodic_runs import periodic_runs, run_report, runs_of, with_planted_periods

from .tables import documents, rows


def brute(words, least=6):
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        x = 0
        while x < n - q:
            begin = x
            while x < n - q and words[x] == words[x + q]:
                x += 1
            length = x - begin + q
            stretch = words[begin:begin + length]
            if length >= max(least, 4 * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                found.append((begin, length, q))
            x += 1 if x == begin else 0
    return sorted(found, key=lambda r: (r[0], r[2]))


def noisy_repeats(rnd):
    words = []
    for _ in range(rnd.randint(0, 6)):
        unit = [str(rnd.randint(0, rnd.choice([0, 1, 2, 40]))).encode() for _ in range(rnd.randint(1, 14))]
        words += (unit * rnd.randint(1, 9))[:rnd.randint(1, 90)]
        if rnd.random() < 0.2:
            words = words * rnd.randint(1, 5)
    return words[:600]


def test_same_runs_as_brute_force():
    rnd = random.Random(11)
    for _ in range(150):
        batch = [noisy_repeats(rnd) for _ in range(rnd.randint(1, 9))]
        assert [[tuple(r) for r in found.tolist()] for found in runs_of(batch)] == [brute(w) for w in batch]


def test_runs_stop_at_the_document():
    assert [r.tolist() for r in runs_of([[b"a"] * 5, [b"a"] * 6, [], [b"a"] * 7])] == [[], [[0, 6, 1]], [], [[0, 7, 1]]]


def test_a_long_text_of_one_word_and_one_of_nested_repeats():
    unit = [b"x"] * 8 + [b"y"]
    (one,), two = (r.tolist() for r in runs_of([[b"w"] * 300_000, unit * 20_000]))
    assert one == [0, 300_000, 1]
    assert [0, 180_000, 9] in two and len(two) == 20_001


def planted(i, words):
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]


def test_report_of_planted_texts(spark):
    rnd = random.Random(3)
    texts = [(i, " ".join(str(rnd.randint(0, 30)) for _ in range(rnd.randint(0, 120)))) for i in range(150)]
    got = {r.doc_id: r for r in run_report(with_planted_periods(documents(spark, texts))).collect()}
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts) > 5
    for i, text in texts:
        words = [w.encode() for w in planted(i, text.split())]
        runs = brute(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()


def test_odd_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "a b " * 5), (4, "a b " * 5), (None, "é" + " é" * 6)], clashing=True)
    got = rows(periodic_runs(docs), "doc_id", "n_words", "runs", "collapsed")
    assert got == sorted([(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 10, [(0, 10, 2)], "a b"), (4, 10, [(0, 10, 2)], "a b"), (None, 7, [(0, 7, 1)], "é")], key=repr)
    assert with_planted_periods(docs).where("doc_id IS NULL").first().text == "é" + " é" * 6
    assert run_report(documents(spark, [])).count() == 0
