import random
import re

from codesift.llm import pii
from llm_data import corpus, empty, frame

AUTOMATON = pii._automaton()


def luhn(digits):
    return sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1])) % 10 == 0


def by_pattern(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def base(text):
    return [s for s in pii.find_spans(text, AUTOMATON) if s[1] < 4]


def test_base_kinds_equal_the_patterns_on_noise():
    rng = random.Random(3)
    for _ in range(20000):
        text = "".join(rng.choice("0142.5 -+@a.b(9)é") for _ in range(rng.randint(0, 45)))
        assert base(text) == by_pattern(text), text


def test_edges():
    for text in ["256.1.1.1 1.2.3.4.5.6.7.8", "0255.00001.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "a@b.c@d.e", "@@a@b.c",
                 "+1 (555) 123-4567.", "+1-", "٣@a.b", "9" * 30000, "1." * 9000, "a@" * 9000]:
        assert base(text) == by_pattern(text), text[:40]


def test_added_kinds():
    text = "see https://a.example/x?q=1. Account number: 1234567890 IBAN DE44 5001 0517 5407 3249 31, accounting 5 ssn: 12"
    got = [(pii.KINDS[k], text[s:e]) for s, k, e in pii.find_spans(text, AUTOMATON) if k > 3]
    assert got == [("url", "https://a.example/x?q=1"), ("account", "1234567890"), ("account", "DE44 5001 0517 5407 3249 31")]


def test_secrets():
    key = "0f3a9b27c4d1e8"
    caught = [f'token = "{key}"', f"api_key: {key}", f"API_KEY={key}", f'"password": "hunter2024"', f"client_secret => '{key}'",
              f"Authorization: Bearer {key}.x", f"secretAccessKey={key}", f"private key : {key}"]
    for text in caught:
        got = [text[s:e] for s, k, e in pii.find_spans("é " + text, AUTOMATON) if k == 6 for s, e in [(s - 2, e - 2)]]
        want = [key + (".x" if "Bearer" in text else "")] if key in text else ["hunter2024"]
        assert got == want, text
    for text in ["the token is lost", "token ring 2024", "password: see below", "a secret, kept for 20 years", "tokens = 12", 'token = "unterminated1234',
                 "bearer of bad news 123456789012", "pwd=short1"]:
        assert not [x for x in pii.find_spans(text, AUTOMATON) if x[1] == 6], text


def test_secret_time_is_linear():
    import time

    for text in ["token=" * 100_000, 'token="x' * 100_000, "token" * 100_000 + "=1", "secret_" * 100_000, "token = " * 100_000, "bearer " * 100_000, "token=" + "a1" * 200_000]:
        begin = time.time()
        pii.find_spans(text, AUTOMATON)
        assert time.time() - begin < 10, text[:20]


def test_table(spark):
    rows = corpus() + [(300, "mail a.b@c.de twice a.b@c.de", "h", "s")] * 2
    got = pii.find_personal_data(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert [len(r.spans) for r in got if r.doc_id == 300] == [2, 2]
    assert all(r.spans == [] for r in got if r.doc_id in (200, 201, 202))
    assert pii.find_personal_data(empty(spark)).count() == 0
