import hashlib
import random
import re
import time

import cases
import pytest

from obligo.llm import pii
from obligo.llm.pii import KINDS, masked, spans_of

PATTERNS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(digits)):
            total += sum(divmod(int(c) * (1 + i % 2), 10))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(value):
    found = [(m.start(), k, m.end()) for k, (kind, pattern) in enumerate(PATTERNS)
             for m in pattern.finditer(value) if passes(kind, m[0])]
    return [f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found)]


def spelled(spans):
    return [f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(4)
    parts = ["@", ".", "a", "b9", "1", "22", "255", "256", "-", " ", "+", "(", ")", "%", "_", "é",
             "4111 1111 1111 1111", "4111111111111111", "١", "\n", "x@y.z", "007", "..",
             "+1 (017) 555-7713", "1.2.3.4", "5" * 5000]
    for _ in range(20_000):
        value = "".join(rng.choices(parts, weights=[20] * 25 + [1], k=rng.randint(1, 18)))
        if "5" * 4301 not in value:  # brute force reads no longer numbers
            assert [x for x in spelled(spans_of(value)) if x.split(":")[0] in KINDS[:4]] == brute(
                value), value
    assert spelled(spans_of("0" * 5000 + "1.2.3.4")) == ["ip:0:5007"]
    assert spelled(spans_of("9" * 5000 + "1.2.3.4")) == []


@pytest.mark.parametrize("value, kind, found", [
    ("pay to DE89 3704 0044 0532 0130 00 now", "iban", "DE89 3704 0044 0532 0130 00"),
    ("GB29NWBK60161331926819.", "iban", "GB29NWBK60161331926819"),
    ("FR14 2004 1010 0505 0001 3M02 606 ABC", "iban", "FR14 2004 1010 0505 0001 3M02 606"),
    ("my social security number: 123-45-6789", "ssn", "123-45-6789"),
    ("numéro de sécurité sociale 1 84 12 76 451 089 46", "nir", "1 84 12 76 451 089 46"),
    ("call me at (030) 123 45 67 today", "local", "(030) 123 45 67"),
])
def test_kinds_of_the_method(value, kind, found):
    assert [(KINDS[k], value[s:e]) for s, k, e, _ in spans_of(value)] == [(kind, found)]


@pytest.mark.parametrize("value", [
    "GB29NWBK60161331926818", "DE89 3704 0044 0532 0130 0", "XX89 3704 0044 0532 0130 00",
    "part 123-45-6789", "ssn 000-45-6789", "ssn 666-45-6789", "ssn 123-00-6789",
    "sécurité sociale 1 84 12 76 451 089 47", "score (030) 123 45 67", "invoice 030 123 45 67",
])
def test_what_no_check_and_no_word_confirms_is_left(value):
    assert [x for x in spans_of(value) if x[1] > 3] == []


def test_words_nearby_adjust_the_score_but_drop_no_base_span():
    def only(value):
        (span,) = spans_of(value)
        return span[3]

    plain = only("x 4111111111111111 y")
    assert only("credit card 4111111111111111") > plain > only("order 4111111111111111")
    assert 0 < only("sample order 4111111111111111") < 0.5


def test_added_spans_overlap_no_other():
    for value in ("tel +49 30 1234567 tel 030 1234567", "ssn 4111-11-1111 1111-11-1111",
                  "iban DE89 3704 0044 0532 0130 00 tel 0532 0130 001234"):
        spans = spans_of(value)
        for a in spans:
            for b in spans:
                assert a is b or a[1] < 4 and b[1] < 4 or a[2] <= b[0] or b[2] <= a[0]


def test_masked_text():
    value = "a@b.example or +1 (017) 555-7713, 😀 10.0.0.1"
    assert masked(value, spans_of(value)) == "[EMAIL] or [PHONE], 😀 [IP]"
    assert masked("nothing", []) == "nothing"


def test_long_texts_take_linear_time():
    for part in ("1", "a", "@", "a@", "+1", "A1", "AB12 ", "(12)", "0 1", "é+1 ", "DE89 3704",
                 "a.b", "1-"):
        began = time.time()
        spans_of(part * (400_000 // len(part)))
        assert time.time() - began < 8, part


def test_awkward_rows_and_empty_table(spark):
    docs = cases.awkward(spark)
    found = pii.personal_data(spark, docs, mask=True).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in cases.ROWS)
    assert not any(r.spans for r in found)
    assert {r.masked for r in found} == {r[1] or "" for r in cases.ROWS}
    assert pii.personal_data(spark, docs.limit(0)).count() == 0


@pytest.mark.skipif(not cases.HAVE_TABLES, reason="no test tables")
def test_query_equals_brute_force(spark):
    rows, texts = pii.query(spark, cases.MIDDLE).collect(), dict(cases.given(cases.MIDDLE))
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(x.startswith(f"{k}:") for x in base) for k in KINDS[:4]]
        spans = [x for x in r.spans.split(",") if x]
        assert [x for x in spans if x.split(":")[0] in KINDS[:4]] == base
    assert all(sum(r[f"n_{k}"] for r in rows) for k in KINDS[:4])
