"""Pages that mark their own text: parts that class or id names inside the article are not content."""

import pytest

from hiremart.llm import html_text as H

PARTS = ["section class='comments'", "div class='ad'", "div class='notice box'", "div id='sidebar'", "div class='ad-slot'", "div class='cookie-banner'", "ol class='comment-list'"]


@pytest.mark.parametrize("part", PARTS)
def test_a_named_part_inside_the_article_is_not_content(part):
    tag = part.split()[0]
    page, label = H.self_labelled(f"<body><article class='post-content'><div class='entry-header'><h1>Title</h1></div><p>Text.</p><{part}><p>Buy this.</p></{tag}><p>End.</p></article></body>")
    assert page.blocks(label) == "Title\nText.\nEnd."


def test_such_pages_do_not_teach_the_model_to_keep_the_part():
    body = "<p>The council met again and spoke at length about the bridge over the river.</p>" * 3
    pages = [f"<body><article>{body}<div class='ad'><p>Offer number {k} of the week is here for all of you.</p></div>{body}</article></body>" for k in range(100)]
    model = H.fit(*H._examples(H.labelled_layouts(60) + [H.self_labelled(p) for p in pages]))
    assert "Offer" not in model.extract(pages[0]) and "council" in model.extract(pages[0])
