import re
from pathlib import Path

import outpulse.llm


def test_driver_reads_are_bounded():
    """What comes to the driver: sums, counts and models of fixed size, and one bounded sample of vectors.

    Arrow tables have a ``take`` of their own, over index arrays inside tasks; Spark's takes a number.
    """
    allowed = {
        "ann.py": 10,  # sample of vectors, trees, counts of leaves and queries
        "decontam.py": 5,  # counts and one filter of at most 32 MB
        "merkle.py": 1,  # rows of the largest group
        "mixing.py": 1,  # three sums
        "quality.py": 3,  # normal equations, calibration, counts
        "lm.py": 1,  # sums over the vocabulary
        "packed.py": 1,  # bytes of the table
        "trie.py": 1,  # turns of the longest conversation
    }
    found = {}
    for path in Path(outpulse.llm.__file__).parent.glob("*.py"):
        calls = re.findall(r"(?<!\bF)\.(collect|first|toPandas|toLocalIterator|head)\(|\.take\(\d", path.read_text())
        if calls:
            found[path.name] = len(calls)
    assert {k: v for k, v in found.items() if v > allowed.get(k, 0)} == {}
