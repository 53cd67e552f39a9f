import re
import textwrap

import pytest

from paylens.llm.license_templates import TEMPLATES
from paylens.llm.licenses import Ranker, Scan, differences, find_licenses, words

RANKER = Ranker(Scan())


@pytest.mark.parametrize("name, text", TEMPLATES)
def test_every_template_wins_its_own_wording(name, text):
    assert RANKER.rank(text)[0][0] == name and RANKER.rank(text)[0][3] == 1.0


def test_a_changed_wording_is_shown():
    text = dict(TEMPLATES)["mit"].replace("free of charge", "at no cost")
    name, rank, reduction, wording, changes = RANKER.rank(text)[0]
    assert (name, rank) == ("mit", 1) and 0.95 < wording < 1 and "free" in changes and "cost" in changes


def test_prose_with_a_legal_word_is_no_license():
    assert RANKER.rank("The driver lost his license after the accident on the old road near the river.") == []
    assert RANKER.rank("") == []


def test_differences():
    assert differences(words("a b c"), words("a x c")) == (2 / 3, "-[x] +[b]")


def test_whole_table(given):
    """Each notice that stands on a line of its own is found there, and nothing else is."""
    docs = given("documents", "sf0.01")
    short = {" ".join(words(text)): name for name, text in TEMPLATES}
    want = set()
    for r in docs.select("doc_id", "text").collect():
        for m in re.finditer("[^\n]+", r.text or ""):
            if " ".join(words(m[0])) in short:
                want.add((r.doc_id, m.start(), m.end(), short[" ".join(words(m[0]))]))
    got = {(r.doc_id, r.start, r.end, r.license) for r in find_licenses(docs).filter("rank = 1").collect()}
    assert want and got == want


def test_odd_rows(spark, odd, none):
    assert find_licenses(odd).collect() == [] and find_licenses(none).collect() == []
    long = "x " * 100_000 + "\nReleased under the MIT License.\n" + "warranty " * 30_000
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "All rights reserved."), (2, long),
            (3, "All rights reserved.\nReleased under the MIT License.")]
    got = find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.license) for r in got) == [
        ("1", "mit-notice"), ("1", "mit-notice"), ("2", "mit-notice"), ("3", "all-rights-reserved"), ("3", "mit-notice"), ("None", "all-rights-reserved")]


PROSE = "The river ran past the old mill, and nobody in the village could say when it had last been used."


@pytest.mark.parametrize("width", [70, 75, 80])
@pytest.mark.parametrize("mark", ["", "# "])
@pytest.mark.parametrize("name, text", TEMPLATES)
def test_wrapped_templates_are_found_with_their_paragraphs(name, text, mark, width):
    """As licences are distributed: short lines, blank lines between paragraphs, other prose around."""
    parts = re.split(r"(?<=[.:])\s+(?=THE|IN NO|This program is|See the|Unless|The above)", text)
    inner = "\n\n".join(textwrap.fill(part, width, initial_indent=mark, subsequent_indent=mark) for part in parts)
    page = f"{PROSE}\n\n{inner}\n\n{PROSE}"
    (start, end), = RANKER.find(page)
    assert page[start:end] == inner
    assert RANKER.rank(page[start:end])[0][0] == name and RANKER.rank(page[start:end])[0][3] == 1.0


def found(page):
    return [(RANKER.rank(page[a:b])[0][0], page[a:b]) for a, b in sorted(RANKER.find(page))]


@pytest.mark.parametrize("name, text", TEMPLATES)
def test_templates_inside_a_line_are_found(name, text):
    (got, part), = found(f"{PROSE} {text} {PROSE}")
    assert got == name and words(part) == words(text)


def test_licences_that_follow_one_another_are_all_found():
    wrapped = {name: textwrap.fill(text, 78) for name, text in TEMPLATES}
    names = ["mit", "bsd-2-clause", "apache-2.0", "mit-notice", "mit-notice", "gpl-3.0", "mit"]
    for between in ("\n", " "):
        assert [name for name, _ in found(between.join(wrapped[n] for n in names))] == names
    notice = dict(TEMPLATES)["mit-notice"]
    assert [name for name, _ in found(f"{notice} " * 500)] == ["mit-notice"] * 500


def test_licences_anywhere_in_a_long_block_are_found():
    text = textwrap.fill(dict(TEMPLATES)["mit"], 78)
    for lines in (1040, 1090, 1110):  # around 20,000 characters
        page = "warranty liability\n" * lines + text + "\ntrademark" * 500
        assert ("mit", text) in found(page)


def test_what_a_longer_licence_leaves_is_scanned_again():
    cut = " ".join(dict(TEMPLATES)["mit"].split()[:-10])
    assert [name for name, _ in found(f"All rights reserved. {cut} Licensed under CC BY 4.0. All rights reserved.")] == [
        "all-rights-reserved", "mit", "cc-by-4.0-notice", "all-rights-reserved"]
