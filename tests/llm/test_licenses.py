import random

import pytest

from tests.llm import brute, cases
from wordtide.llm import licenses


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def expected(text, templates=licenses.TEMPLATES, least=0.8):
    """Best containment of each licence, over all windows."""
    found, inside = {}, shingles(brute.plain(text))
    for name, statements in templates.items():
        for statement in statements:
            wanted = shingles(brute.plain(statement))
            span = 1
            while span < len(wanted):
                span *= 2
            for low in range(0, len(inside), span):
                share = len(set(wanted) & set(inside[low : low + 2 * span])) / len(set(wanted))
                if share >= least:
                    found[name] = max(found.get(name, 0), share)
    return found


def rows():
    pick, found = random.Random(8), cases.passages()
    statements = [s for texts in licenses.TEMPLATES.values() for s in texts]
    for i in range(150):
        words = cases.words((8, i), pick.randrange(0, 60))
        statement = pick.choice(statements).split()
        if i % 3 == 0:
            statement[pick.randrange(len(statement))] = "other"
        if i % 5 == 0:
            statement = [w.upper() for w in statement]
        cut = pick.randrange(0, len(words) + 1)
        found.append((100 + i, " ".join(words[:cut]) + "\n" + " ".join(statement) + ".\n" + " ".join(words[cut:])))
    found += [
        (300, "Licensed under CC BY-NC 4.0."), (301, "Licensed under CC BY"), (302, "Released under the MIT License."),
        (303, "released-under/the:mit LICENSE " * 5_000), (304, "under the MIT License"),
        (305, "This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY 4.0."),
    ]
    return found


def test_against_all_windows(spark):
    data = rows()
    docs = cases.frame(spark, data).withColumnRenamed("row", "matches")
    found = licenses.license_matches(docs).collect()
    assert len(found) == len(data) and all(r.found == "own" for r in found)
    got = sorted([(r.doc_id, sorted((m.license, m.containment) for m in r.matches)) for r in found], key=repr)
    assert got == sorted([(i, sorted(expected(t).items())) for i, t in data], key=repr)
    by_id = {r.doc_id: r.matches for r in found}
    assert (by_id[300][0].first_word, by_id[300][0].end_word) == (0, 7)
    assert [m.license for m in by_id[305]] == ["CC-BY-4.0", "GPL-3.0"]


def test_bands_keep_their_promise():
    for size, span in ((1, 1), (5, 8), (100, 128)):
        n = licenses.bands_needed(size, span, 0.8, 1e-6)
        similarity = 0.8 * size / (2 * span + 0.2 * size)
        assert (1 - similarity) ** n <= 1e-6 < (1 - similarity) ** (n - 1)


def test_no_documents_and_bad_templates(spark):
    assert licenses.license_matches(cases.frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        licenses.Catalogue({"x": ("too short",)})
