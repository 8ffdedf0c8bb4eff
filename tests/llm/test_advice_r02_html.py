"""Elements left out of the main text that are never closed."""

import pytest

from batchkit.llm import html


@pytest.mark.parametrize("element", ["<svg class='x' />", "<select><option>a", "<object data=x>", "<canvas>", "<iframe src=x>"])
def test_text_after_an_unclosed_element_stays(element):
    page = f"<p>before</p>{element}<p>after <b>it</b></p><div>end</div>"
    assert [leaf.text for leaf in html.leaves(page)] == ["before", "after it", "end"]


def test_closed_and_raw_elements_are_left_out():
    page = "<p>a</p><noscript><p>no</p></noscript><svg><g/></svg><select><option>x</select><p>b</p><script>no <p>no"
    assert [leaf.text for leaf in html.leaves(page)] == ["a", "b"]
