"""No part of an article is lost because another part is longer."""

import pytest

from clearlot.llm import html_extract

LEAD = "A lead that tells in some words what follows. " * 3
TEXT = "The long text of the article goes on and on here. " * 18
END = "A last remark that is much shorter than the text. " * 2


@pytest.mark.parametrize(
    "page",
    [
        "<div><div>{lead}</div><section>{text}</section></div>",
        "<body><div><section>{lead}</section><section>{text}</section><section>{end}</section></div></body>",
        "<table><tr><td>{lead}</td><td>{text}</td></tr><tr><td>{end}</td></tr></table>",
        "<body><div><p>{lead}</p><div><div>{text}</div></div><p>{end}</p></div></body>",
        "<article><p>{lead}</p><article><p>{text}</p></article><p>{end}</p></article>",
        "<main><article>{lead}</article><article>{text}</article></main>",
        "<main><p>{lead}</p><article><p>{text}</p></article><section>{end}</section></main>",
    ],
)
def test_parts_of_uneven_size_are_all_kept(page):
    menu = "<nav><a>Home</a><a>About us</a></nav><div class=sidebar>" + "Words beside the text. " * 9 + "</div>"
    parts = {"lead": LEAD, "text": TEXT, "end": END}
    want = [part.strip() for name, part in parts.items() if f"{{{name}}}" in page]
    assert html_extract.main_lines(menu + page.format(**parts)) == want


def test_an_article_still_bounds_the_region():
    page = f"<body><div>{LEAD}</div><main><div>Home</div><article><h1>Head</h1><p>{TEXT}</p></article></main></body>"
    assert html_extract.main_lines(page)[-2:] == ["Head", TEXT.strip()]
    assert LEAD.strip() not in html_extract.main_lines(page)
