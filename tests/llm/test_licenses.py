import math
import re
import textwrap

import pytest

from cellweave.llm import licenses as L

CLEAN = ["The river ran past the old mill and the public garden.", "Nothing is granted here, and nobody may use the name.", "A copy of the notes was free of charge in the library.", "", None, "  \n \n", "Ünder thé terms öf nothing", "0", "a " * 3000]


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_families_are_found_and_others_left_alone(make, model):
    texts = CLEAN + [f"Some words before.\n{t}.\nAnd after." for family in L.TEMPLATES.values() for t in family]
    expected = [""] * len(CLEAN) + [f for f, family in L.TEMPLATES.items() for _ in family]
    rows = sorted(L.scan(make(texts), model).collect())
    assert [r.families for r in rows] == expected and all((r.n_licenses == 1) == bool(f) for r, f in zip(rows, expected, strict=True))


def test_not_confirmed(make, model):
    # like the licence's words, but too little of any notice
    row = L.classify(make(["apache license licensed licensed under apache apache.org licenses compliance"]), model).collect()
    assert all(not r.confirmed for r in row)


def test_two_in_one_text_and_repeats(make, model):
    row = L.scan(make(["Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License."]), model).first()
    assert (row.families, row.n_licenses) == ("cc-by-nc,mit", 3)
    assert L.scan(make([]), model).count() == 0


def test_logits_against_all_runs(spark, make, model):
    """No run of lines that the table's weights put into a family is lost by leaving out those with weak words alone."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).collect()] + CLEAN + [wrapped(t, "# ", 40) for f in L.TEMPLATES.values() for t in f]
    weights = {x["group"]: x["w"] for x in model.weights}
    found = {(r.doc_id, r.line, r.n_lines): (r.family, r.probability) for r in L.scored(make(texts), model).collect()}
    expected = {}
    for i, text in enumerate(texts):
        lines = [[w for w in re.split(r"[^\w]+|_", line.lower()) if w] for line in (text or "").split("\n")]
        for k in range(len(lines)):
            for n in range(1, len(lines) - k + 1):
                words = sum(lines[k : k + n], [])
                if not all(lines[k : k + n]) or (n > L.LINES and len(words) > L.WORDS):
                    break
                groups = {" ".join(words[a : a + m]) for m in (1, 2, 3) for a in range(len(words) - m + 1)}
                x = [(b + sum(weights[g][j] for g in groups if g in weights)) / model.temperature for j, b in enumerate(model.intercepts)]
                best = max(range(len(x)), key=x.__getitem__)
                if model.families[best] != L.UNKNOWN:
                    expected[i, k, n] = (model.families[best], 1 / sum(math.exp(v - x[best]) for v in x))
    assert {k: f for k, (f, _) in found.items()} == {k: f for k, (f, _) in expected.items()}
    assert all(abs(found[k][1] - p) < 1e-9 for k, (_, p) in expected.items())


def wrapped(text, mark, width):
    return "\n".join(mark + x for x in textwrap.wrap(text, width - len(mark), break_long_words=False, break_on_hyphens=False))


@pytest.mark.parametrize(("mark", "width"), [("", 72), ("# ", 72), (" * ", 50), ("// ", 40), ("", 30), (" * ", 24), ("", 18), ("# ", 18), ("", 1)])
def test_hard_wrapped_notices(make, model, mark, width):
    """Wrapped, behind comment marks, and between other lines of a block."""
    templates = [(f, t) for f, family in L.TEMPLATES.items() for t in family]
    around = [f"{mark}Copyright of the authors.\n{wrapped(t, mark, width)}\n{mark}Written in the spring.\n{mark.strip()}\n{mark}Nothing else." for _, t in templates]
    rows = sorted(L.scan(make([wrapped(t, mark, width) for _, t in templates] + around), model).collect())
    assert [r.families for r in rows] == [f for f, _ in templates] * 2 and all(r.n_licenses == 1 for r in rows)


def test_equal_rows_and_shared_ids(make, model):
    """A row's result doesn't depend on other rows."""
    texts = ["Licensed under version 3 of the license", "Licensed under CC BY 4.0", "Released under the MIT License", "The river ran.\nReleased under the BSD License"]
    alone = {t: tuple(L.scan(make([t]), model).first())[1:] for t in texts}
    rows = L.scan(make(texts * 2 + texts, ids=[1, 2, 3, 4] * 2 + [None, None, 1, 1]), model).collect()
    assert sorted((r.doc_id or 0, *tuple(r)[1:]) for r in rows) == sorted((i, *alone[t]) for i, t in zip([1, 2, 3, 4] * 2 + [0, 0, 1, 1], texts * 3, strict=True))


def test_empty_and_very_long(spark, make, model):
    assert L.scan(make([]), L.train(make([]))).count() == 0
    long = "a line of words\n" * 30000
    row = L.scan(make([long + "Licensed under CC BY 4.0." + long, "x" * 300000]).withColumnsRenamed({"lang": "line", "source": "family", "piece": "t", "text_": "words"}), model).collect()
    assert sorted((r.doc_id, r.families) for r in row) == [(0, "cc-by"), (1, "")]


def test_weak_words():
    weights = [{"group": "the license", "w": [1.0, 0.0]}, {"group": "of", "w": [0.5, 0.0]}, {"group": "gnu", "w": [3.0, -1.0]}, {"group": "a", "w": [-2.0, 1.0]}]
    assert L.telling_words(weights, [0.0, 2.0], {"the": 9, "of": 5, "license": 1}) == ["gnu"]
    assert L.telling_words(weights, [0.0, 1.2], {"the": 9, "of": 5, "license": 1}) == ["license", "gnu"]


def test_no_python_in_the_plan(spark, make, model):
    plan = L.scan(make(["x"]), model)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
