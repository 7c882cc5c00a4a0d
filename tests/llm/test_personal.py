"""Personal data: base spans against plain regular expressions, the training against cases whose labels are known."""

import hashlib
import random
import re

from cellweave.llm import personal as P

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if passes(k, m[0])]
    return sorted(found)


def check(rows, texts, ids=None):
    """rows: collected, one for each text."""
    want = sorted(((ids or range(len(texts)))[i] if (ids or range(len(texts)))[i] is not None else -1, *[sum(s[3] == k for s in base(t)) for k in PLAIN], hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in base(t)).encode()).hexdigest()) for i, t in enumerate(texts))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows)
    assert got == want
    for r in rows:
        spans = r.spans.split(",") if r.spans else []
        own = [s for s in spans if hashlib.sha256(s.encode()).hexdigest() == r.base_sha256] if len(spans) == 1 else spans
        assert len(spans) >= r.n_email + r.n_ip + r.n_card + r.n_phone and len(own) <= len(spans)
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


TRICKY = [
    "a@b.c_d@e.f g@h@i.j @k.l m@n. o.p@q..r s@t.u-v.w@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 1.2.3 99999999999999999999.1.1.1 1..2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111 1111  1111 1111 0 00 00000000000000 5500000000000004x 79927398713 4111111111111111 2",
    "+1 (743) 555-3824 +12 +1234567890123456 +1-2 +1 2 3 4 5 6 7 8 9 0) +++12345678901 +123-456-7890.", "日本 a@b.co 日 +49 30 1234567 \U0001f44d 1.1.1.1 \U0001f44d4111111111111111",
    "a" * 2000, "1" * 2000, "1 " * 1000, "1." * 1000, "+1" * 1000, "a@b.c " * 300, "a@" * 1000, "x\ny@z.q\n+1 (111) 111-1111\x01\x02",
]


def test_base_spans_of_odd_texts(make, odd):
    texts = [*odd, *TRICKY]
    check(P.scan(make(texts)).collect(), texts)


def test_very_long_texts(make):
    """Plain patterns would go back over these for hours; their spans are known."""
    n = 300_000
    texts = ["a" * n + " a@b.cd", "1" * n, "1 " * n, "1." * n, "+1" * n, "a@b.c " * 20_000, "a@" * n, "A" * n + " +1 (743) 555-3824"]
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans[-22:]) for r in P.scan(make(texts)).collect()}
    none = (0, 0, 0, 0, "")
    assert got[0] == (1, 0, 0, 0, f"email:{n + 1}:{n + 7}") and got[1] == got[2] == got[4] == got[6] == none
    assert got[3][:4] == (0, n // 4, 0, 0) and got[5][:4] == (20_000, 0, 0, 0) and got[7] == (0, 0, 0, 1, f"phone:{n + 1}:{n + 18}")


def test_equal_rows_shared_and_missing_ids(make):
    texts = ["mail a@b.com", "mail a@b.com", "call +1 (743) 555-3824", None, "mail a@b.com", "mail a@b.com"]
    ids = [1, 1, 1, 1, None, None]
    check(P.scan(make(texts, ids)).collect(), texts, ids)


def test_whole_table(spark, real):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(P.scan(docs).collect(), real.text.tolist(), real.doc_id.tolist())


def test_no_documents_and_no_candidates(make):
    assert P.scan(make([])).count() == 0
    texts = [None, "", "nothing here"]
    check(P.scan(make(texts)).collect(), texts)


def corpus():
    """Texts with personal data in looser forms, and with numbers that are something else."""
    draw = random.Random(12)
    n = lambda k: "".join(str(draw.randrange(1, 10)) for _ in range(k))
    good = [
        lambda: f"please call ({n(3)}) {n(3)}-{n(4)} today", lambda: f"phone 00{n(2)} {n(3)} {n(7)} is mine", lambda: f"write to anna{n(2)} at mail{n(1)} dot com soon",
        lambda: f"contact eva{n(2)} [at] web{n(1)} [dot] org now", lambda: f"my name is {draw.choice(P.GIVEN_NAMES)} Miller", lambda: f"social security {n(3)}-{n(2)}-{n(4)} given",
    ]
    bad = [lambda: f"release 300.{n(3)}.{n(2)}.{n(1)} is out", lambda: f"order {n(16)}1 shipped", lambda: f"build version +{n(5)} of it", lambda: f"part {n(3)}-{n(2)}-{n(4)} of the list"]
    rows = []
    for i in range(400):
        kind = i % 4
        rows.append((draw.choice(good)() if kind == 0 else draw.choice(bad)() if kind == 1 else f"mail x{n(3)}@host{n(1)}.com or call +1 ({n(3)}) {n(3)}-{n(4)}" if kind == 2 else "plain words only", kind))
    return rows


def test_looser_forms_are_added_and_other_numbers_are_not(make):
    rows = corpus()
    got = {r.doc_id: r for r in P.scan(make([t for t, _ in rows])).collect()}
    check(got.values(), [t for t, _ in rows])
    extra = {i: (len(r.spans.split(",")) if r.spans else 0) - (r.n_email + r.n_ip + r.n_card + r.n_phone) for i, r in got.items()}
    found = [extra[i] == 1 for i, (_, kind) in enumerate(rows) if kind == 0]
    assert sum(found) >= 0.9 * len(found)
    assert sum(extra[i] for i, (_, kind) in enumerate(rows) if kind != 0) <= 2
    again = {r.doc_id: r.spans for r in P.scan(make([t for t, _ in rows])).collect()}
    assert again == {i: r.spans for i, r in got.items()}


def test_reliabilities_are_recovered():
    """Labelers of known reliability vote on items of known classes."""
    draw, chances = random.Random(3), [0.95, 0.9, 0.85, 0.7, 0.8, 0.9]
    counts, truth = {}, {}
    for _ in range(20_000):
        y = draw.random() < 0.4
        votes = tuple(-1 if draw.random() < 0.2 else int(y if draw.random() < c else not y) for c in chances)
        counts[votes] = counts.get(votes, 0) + 1
        truth.setdefault(votes, []).append(y)
    share, right, posterior = P.reliabilities([("email", v, n) for v, n in counts.items()])
    assert abs(share["email"] - 0.4) < 0.02
    assert all(abs(both[y][y] / (both[y][0] + both[y][1]) - c) < 0.03 for both, c in zip(right, chances, strict=True) for y in (0, 1))
    hits = sum((posterior["email", v] > 0.5) == y for v, ys in truth.items() for y in ys)
    assert hits > 0.97 * 20_000


def test_main_path_has_no_python(make):
    plan = P.candidates(make(["a@b.com"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
