import pytest

from revtide.operators.responses import HEADINGS, response_sections


@pytest.fixture
def split(frame):
    def run(text):
        rows = response_sections(frame("id int, t string", [(1, text)]), ["id"], "t").collect()
        assert {r.id for r in rows} == {1}
        whole = {r.section: r.item for r in rows if r.item_no == 0}
        items = {}
        for r in sorted(rows, key=lambda r: r.item_no):
            if r.item_no:
                items.setdefault(r.section, []).append(r.item)
        assert set(whole) == set(HEADINGS)
        return whole, items
    return run


def test_all_headings(split):
    whole, items = split(
        '"## Headline:\\nUp\n\nExecutive Summary :\n A\tb \n\nKey Risks:\n1. one\n2.two\nnot\n 3.  three \n'
        'recommended actions:\n12. go\n- no"'
    )
    assert whole["Headline"] == "Up"
    assert whole["Executive Summary"] == "A\tb"
    assert whole["Key Risks"] == "1. one\n2.two\nnot\n 3.  three"
    assert items == {"Key Risks": ["one", "two", "three"], "Recommended Actions": ["go"]}


def test_no_heading_is_the_summary(split):
    whole, items = split("  'Key Risks: inline is no heading\n1. x'  ")
    assert whole["Executive Summary"] == "Key Risks: inline is no heading\n1. x"
    assert whole["Key Risks"] == "" and items == {}


@pytest.mark.parametrize("text", [None, "", "   ", '"', '""', "###"])
def test_empty_texts(split, text):
    whole, items = split(text)
    assert set(whole.values()) == {""} and items == {}


def test_repeated_heading_and_preamble(split):
    whole, items = split("dropped\nKey Risks:\n1. old\nKEY RISKS:\n1. new\n2.\n3. \n")
    assert whole["Key Risks"] == "1. new\n2.\n3."
    assert items == {"Key Risks": ["new"]}
    assert whole["Executive Summary"] == ""


def test_adjacent_headings_and_line_ends(split):
    whole, items = split("Headline:\nKey Risks:\r\n1. a\r\n2. b 3. c\nHeadline:\n")
    assert whole["Headline"] == ""
    assert items == {"Key Risks": ["a", "b", "c"]}


def test_text_is_kept_whole(split):
    body = "word " * 20000
    whole, _ = split("Headline:\n" + body)
    assert whole["Headline"] == body.strip()
