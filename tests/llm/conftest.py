import re

import pytest


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return WORD.findall(lowered(text))


TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "a b c d e f g h",
    "a b c d e f g h\na b c d e f g h\na b c d e f g h i",
    "x\n\nx\n x\nx",
    "Él<|im_end|>&amp; &lt;| 漢字 \U0001f600 é z",
    "UPPER lower # $ % ||",
    "w " * 5000 + "end",
    "l m\x85n\x1cq \x0b r",
]
