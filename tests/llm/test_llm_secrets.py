from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from strata.llm import secrets


def _token(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_merging_finds_the_cycle_of_a_regular_language():
    rng = random.Random(5)
    words = ["a" + "bc" * int(math.log(1 - rng.random()) / math.log(0.6)) for _ in range(600)]
    automaton = secrets.infer(words)
    assert len(automaton.step) <= 4 < len(max(words, key=len))
    assert automaton.likelihood("a" + "bc" * 20) > automaton.likelihood("a" + "bcb" * 13) + 1


def test_likelihoods_of_all_words_sum_to_at_most_one():
    automaton = secrets.infer(["ab", "ab", "aab", "b"] * 20)
    total = 0.0
    words = [""]
    for _ in range(8):
        total += sum(2 ** (automaton.likelihood(w) * (len(w) + 1)) for w in words)
        words = [w + s for w in words for s in "ab"]
    assert 0.8 < total <= 1.0 + 1e-9


def test_learned_formats_add_spans_and_spare_prose(spark):
    rng = random.Random(2)
    hexes = [_token(rng, "0123456789abcdef", 40) for _ in range(300)]
    prose = [_token(rng, "etaoinshrdluc", rng.randint(12, 24)) for _ in range(300)] + ["self-contained-words"]
    texts = [f"some words {rng.choice(prose)} then token = '{h}' more {rng.choice(prose)}" for h in hexes]
    split = _token(rng, "0123456789abcdef", 14) + "_" + _token(rng, "0123456789abcdef", 14)  # no base pattern matches it
    texts.append(f"unmarked {split} here")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    formats = secrets.fit(docs)
    out = docs.select("doc_id", secrets.find_secrets(formats, F.col("text"), spark).alias("s")).collect()
    learned = {(r["doc_id"], texts[r["doc_id"]][s["start"] : s["end"]]) for r in out for s in r["s"] if s["kind"] == "format"}
    assert learned == {(len(texts) - 1, split)}


def test_redaction(spark):
    rows = [("key password=abcdefghijkl end",), (None,), ("clean",), ("AKIA" + "A" * 20 + " token:0123456789abcdef0123",)]
    docs = spark.createDataFrame(rows, "text string")
    formats = secrets.fit(docs)
    out = docs.withColumn("s", secrets.find_secrets(formats, F.col("text"), spark)).select(secrets.redact(F.col("text"), F.col("s")).alias("t"))
    assert {r["t"] for r in out.collect()} == {"key [assign] end", None, "clean", "[access] [assign]"}


def test_dotted_and_prefixed_credentials_are_found(spark):
    """Unmarked credentials of parts joined by dots, and behind a path or an unlisted name."""
    rng = random.Random(4)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    dotted = lambda: ".".join(_token(rng, alphabet, n) for n in (8, 20, 16))
    plain = lambda: _token(rng, alphabet, 40)
    prose = [_token(rng, "etaoinshrdluc", rng.randint(12, 24)) for _ in range(300)]
    texts = [f"{rng.choice(prose)} token = '{dotted()}' and secret: {plain()} {rng.choice(prose)}" for _ in range(300)]
    first = len(texts)
    bare = [dotted(), plain(), plain(), plain(), dotted()]
    frames = ["unmarked {} here", "auth={} here", "see v1/hooks/{} there", "see authentication/hooks/incoming/{} there", "it is {}. Then"]
    texts += [f.format(c) for f, c in zip(frames, bare, strict=True)] + ["see etaoinshrdlu/hooks/incoming.authentication there"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    formats = secrets.fit(docs)
    for i, c in enumerate(bare):
        spans = [texts[first + i][s:e] for kind, s, e, _ in secrets.scan(texts[first + i], formats) if kind == "format"]
        assert spans == [c]
    assert secrets.scan(texts[-1], formats) == []


def _plain_scan(text, formats):
    """Every stretch scored by itself, every overlap tested against all spans."""
    base = secrets.base_spans(text)
    found = []
    for m in secrets._TOKEN.finditer(text):
        for a, b in secrets.pieces(m.group(), formats.most_parts):
            score = formats.score(m.group()[a:b])
            s, e = m.start() + a, m.start() + b
            if score is not None and score >= formats.least_score and not any(x < e and s < y for _, x, y, _ in base):
                found.append((score * (e - s + 1), s, e, score))
    out, taken = [(k, s, e, None) for k, s, e, _ in base], []
    for _, s, e, score in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
        if not any(x < e and s < y for x, y in taken):
            taken.append((s, e))
            out.append((secrets.FORMAT, s, e, score))
    return sorted(out, key=lambda s: (s[1], secrets._RANK[s[0]]))


def _formats(rng, most):
    word = lambda n: _token(rng, "ABCDEFGHabcdefgh0123456789", n)
    kinds = {k: (secrets.infer([secrets.symbols(word(30) + "." + word(9)) for _ in range(60)]), -4.5) for k in ("assign", "access")}
    return secrets.Formats(kinds, secrets.infer([secrets.symbols(_token(rng, "etaoinshr.", 14)) for _ in range(200)]), 0.05, most)


def test_scan_against_plain_loops():
    rng = random.Random(8)
    found = 0
    for most in (1, 3, 50):
        formats = _formats(rng, most)
        for _ in range(60):
            runs = [_token(rng, "ABCabc012345./=_-+", rng.randint(1, 60)) for _ in range(rng.randint(0, 8))]
            text = rng.choice([" ", " token=", "..", "/"]).join(["start", *runs, "AKIA" + _token(rng, "AB01", 18)])
            got = secrets.scan(text, formats)
            assert got == _plain_scan(text, formats)
            found += sum(k == secrets.FORMAT for k, *_ in got)
    assert found > 20


def test_long_runs_and_many_spans():
    """A marked value of 400 KB in thousands of parts, and 20,000 spans in one text, take seconds."""
    import time

    rng = random.Random(9)
    formats = _formats(rng, 5000)
    value = _token(rng, "ABCDEFGHabcdefgh0123456789+/", 400_000)
    many = " ".join(_token(rng, "0123456789abcdef", 16) + " " + _token(rng, "ABCabc0123456789", 20) for _ in range(20_000))
    began = time.perf_counter()
    assert [s[:3] for s in secrets.scan(f"token={value}", formats) if s[0] == "assign"] == [("assign", 0, 400_006)]
    assert sum(k == "hex" for k, *_ in secrets.scan(many, formats)) >= 20_000
    assert time.perf_counter() - began < 60
