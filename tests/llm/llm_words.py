"""The words of the contracts, told by a plain pattern."""

import re

GAP = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return GAP.findall(text or "")


def lowered(text):
    return [w.translate({k: k + 32 for k in range(65, 91)}) for w in words(text)]
