"""Only the hidden attribute hides an element."""

import pytest

from topicpulse.llm import html_extract

TEXT = "The first paragraph has a sentence of its own. The second one is here, too."


@pytest.mark.parametrize("attrs", ['class="row hidden wide"', 'title="the hidden cost"', "data-x='a hidden b'", 'class = "x hidden y" id=z'])
def test_the_word_in_a_value_hides_nothing(attrs):
    assert html_extract.main_text(f"<body><main><div {attrs}><p>{TEXT}</p></div></main>") == TEXT


@pytest.mark.parametrize("attrs", ["hidden", "id=a hidden", 'hidden=""', "hidden = 'until-found' class=b", 'title="x" hidden', 'class="a"hidden'])
def test_the_attribute_hides(attrs):
    assert TEXT not in html_extract.main_text(f"<body><main><div {attrs}><p>{TEXT}</p></div><p>Seen by all.</p></main>")
