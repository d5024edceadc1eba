"""Texts of many megabytes: steps of bounded size give what one step gives."""

import numpy as np
import pyarrow as pa

from curatrix.llm import common, jaccard_join, language_id, line_dedup, secrets

WORDS = [f"w{k}" for k in range(3000)]


def test_steps_change_nothing(monkeypatch):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(WORDS, 3000)) + "  \t" + "é" * 700 + "\nA" + "b" * 900, "x" * 5000, "", " a " * 600, "\n" + "Ö" * 3]
    flat, bounds = common.text_buffers(pa.array(texts))
    whole = [common.hash_words(flat, bounds[i : i + 2]) for i in range(len(texts))]
    lines = [t.encode() for t in texts if t]
    marks, counts = line_dedup.gram_marks(lines), language_id._counts(lines)
    for step in (64, 1000, 4096):
        monkeypatch.setattr(common, "STEP_BYTES", step)
        monkeypatch.setattr(line_dedup, "STEP_BYTES", step)
        monkeypatch.setattr(language_id, "COUNTED", step)
        for i, want in enumerate(whole):
            for a, b in zip(common.hash_words(flat, bounds[i : i + 2]), want, strict=True):
                assert a.tolist() == b.tolist()
        assert (language_id._counts(lines) == counts).all()
        monkeypatch.setattr(line_dedup, "steps", lambda offsets, s=step: common.steps(offsets, s))
        assert all((a == b).all() for a, b in zip(line_dedup.gram_marks(lines), marks, strict=True))


def test_fifty_megabytes():
    rng = np.random.default_rng(1)
    words = np.array([f"{'x' * int(rng.integers(1, 9))}{k}" for k in range(5000)])
    text = " ".join(rng.choice(words, 5_400_000))
    assert len(text) > 50_000_000
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([text])], ["doc_id", "row_key", "text"])
    n = next(jaccard_join._classes(iter([batch]), 5)).column("n")[0].as_py()
    assert 5_300_000 < n <= 5_400_000 - 4
    (told,) = line_dedup._lines(iter([batch]), True)
    assert told.column("lengths")[0].as_py()[0] > 49_000_000
    assert abs(language_id._counts([text.encode()]).sum(dtype=float) - 3 * len(text)) < 100  # counts are single floats
    (found,) = secrets._scan(iter([batch.select(["doc_id", "text"])]))
    assert found.column("spans")[0].as_py() == ""


def test_many_spans_take_time_in_proportion():
    text = ("é password=abcdefgh1 " * 40_000).encode()
    found = secrets._text_spans(text, [], [(a, a + 18) for a in range(0, 100)])
    told = secrets._told(text, found)
    assert len(told) == 40_000 and told[0] == "assign:2:20" and told[-1] == f"assign:{39_999 * 21 + 2}:{39_999 * 21 + 20}"


def test_filler_takes_only_its_windows_away():
    rng = np.random.default_rng(2)
    chars = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz123456789")
    for _ in range(200):
        head, tail = ("".join(rng.choice(chars, 60)) for _ in range(2))
        key = (head + "0000" + tail).encode()
        spans = secrets.entropy_spans(key)
        assert any(a < 40 for a, _ in spans) and any(b > 84 for _, b in spans)
        # brute force over windows: each lies in a span if it's random and has no filler
        for a in range(len(key) - 19):
            window = key[a : a + 20]
            if not secrets.FILLER.search(window) and secrets.random_windows(window, 3.8):
                assert any(x <= a and a + 20 <= y for x, y in spans)
    assert not secrets.entropy_spans(b"0" * 40 + b"x" * 40) and not secrets.entropy_spans(b"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY")
