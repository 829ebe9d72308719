import hashlib
import random
import re

import numpy as np
from cases import clashing, edge_texts, frame, prose

from stageline.llm.pii import WINDOW, Tagger, base_spans, cut, codes, luhn, personal_data, spans_of, tags_of, training_windows, windows_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda m, d: True,
                "ip": lambda m, d: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda m, d: 12 <= len(d) <= 19 and luhn(d),
                "phone": lambda m, d: 9 <= len(d) <= 15,
            }[kind]
            if ok(m, digits):
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def private_text(rng):
    kinds = [
        lambda: f"x{rng.randrange(99)}.y@mail{rng.randrange(9)}.example.com",
        lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
        lambda: "4111 1111 1111 1111",
        lambda: f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
    ]
    return prose(rng, 12) + " " + rng.choice(kinds)() + " " + prose(rng, 12)


def test_base_spans_against_patterns():
    rng = random.Random(2)
    letters = "ab1234567890@.+-() _%é"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(4000)]
    texts += [private_text(rng) for _ in range(50)] + ["a@b.c@d.e", "1.2.3.4.5.6.7.8", "1.2.3.4567 1.2.3.400", "@a.b", "x@@a.b", "+1 4111111111111111"]
    for t in texts:
        assert [f"{list(PATTERNS)[k]}:{a}:{b}" for k, a, b in base_spans(t)] == brute(t)


def test_long_runs_are_linear():
    for t in ("a" * 300_000, "1" * 300_000, "a@" * 50_000, "+1" + "(" * 200_000):
        base_spans(t)


def test_gradients():
    rng = np.random.default_rng(1)
    tagger = Tagger(hidden=4)
    x, y = rng.integers(0, 20, (3, 9)), rng.integers(0, 9, (3, 9))
    _, grads = tagger.loss(x, y)
    for key, value in tagger.p.items():
        at = np.unravel_index(np.abs(grads[key]).argmax(), value.shape)
        value[at] += 1e-5
        up = tagger.loss(x, y)[0]
        value[at] -= 2e-5
        down = tagger.loss(x, y)[0]
        value[at] += 1e-5
        assert np.isclose((up - down) / 2e-5, grads[key][at], rtol=1e-3)


def test_tagger_learns_spans():
    rng = random.Random(4)
    x, y = [], []
    for _ in range(500):
        t = private_text(rng)
        tags = np.concatenate((tags_of(base_spans(t), len(t)), np.zeros(WINDOW, int)))
        for s in windows_of(t):
            x.append(cut(codes(t), np.array([s]))[0])
            y.append(tags[min(s, len(t)) :][:WINDOW])
    x, y = np.array(x, int), np.array(y)
    tagger = Tagger().train(x[:600], y[:600])
    got = [(set(spans_of(tagger.decode(e))), set(spans_of(t))) for e, t in zip(tagger.scores(x[600:1000]), y[600:1000], strict=True)]
    hit = sum(len(a & b) for a, b in got)
    assert hit / max(1, sum(len(a) for a, _ in got)) > 0.8 and hit / sum(len(b) for _, b in got) > 0.7


def test_personal_data(spark):
    rng = random.Random(6)
    texts = edge_texts() + [private_text(rng) for _ in range(60)] + ["é" * 70 + " 1.2.3.4", "call (212) 555-0199 now"]
    rows = {r.doc_id: r for r in personal_data(clashing(frame(spark, texts))).collect()}
    assert len(rows) == len(texts)
    for doc, text in enumerate(texts):
        want = brute(text)
        r = rows[doc]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in PATTERNS]
        if not re.search("[0-9@]", text or ""):
            assert r.spans == "" and r.found == []
    assert personal_data(frame(spark, ["no data", None])).where("spans = ''").count() == 2
    assert personal_data(frame(spark, [])).count() == 0


def test_copies_do_not_fill_the_sample(spark):
    rng = random.Random(4)
    texts = [f"copy mail a{i}@b.example end" for i in range(3) for _ in range(400)]
    texts += [f"{prose(rng, 4)} write to c{i}@d.example now" for i in range(40)]
    x, y = training_windows(frame(spark, texts).select("text"), 40)
    rows = [bytes(a.astype(np.uint8)) + bytes(b.astype(np.uint8)) for a, b in zip(x, y, strict=True)]
    assert len(rows) == len(set(rows)) and (y.sum(1) > 0).sum() == 20
