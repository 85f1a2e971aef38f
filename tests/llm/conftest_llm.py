"""Small helpers shared by the tests of the training-data operators."""

import re


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(text or "")


