"""Every rule must fire on what its expression describes, through the keywords."""

import re._parser as parser
from itertools import islice, product

import pyarrow as pa
import pytest

from loanloom.llm import licenses


def examples(pattern):
    """Texts that an expression describes: every alternative, optional parts there and not."""

    def of(parsed):
        parts = [list(one(op, value)) for op, value in parsed]
        return ("".join(p) for p in product(*parts))

    def one(op, value):
        op = str(op)
        if op == "LITERAL":
            return [chr(value)]
        if op == "IN":
            return [c for kind, v in value for c in member(str(kind), v)]
        if op == "BRANCH":
            return [x for branch in value[1] for x in of(branch)]
        if op == "SUBPATTERN":
            return of(value[-1])
        assert op == "MAX_REPEAT", op
        low, _, inner = value
        return ["".join(p) for n in {low, max(low, 1)} for p in product(list(of(inner)), repeat=n)]

    def member(kind, value):
        if kind == "LITERAL":
            return [chr(value)]
        if kind == "RANGE":
            return [chr(c) for c in range(value[0], value[1] + 1)][:3]
        return {"CATEGORY_DIGIT": ["7"], "CATEGORY_WORD": ["w"]}[str(value)]

    return list(islice(of(parser.parse(pattern)), 3000))


def detections(texts, rules):
    names = list(licenses.RESULT)
    batch = pa.RecordBatch.from_pydict({"__text": pa.array(texts, pa.string())})
    return [d for b in licenses._scan(iter([batch]), names, rules) for d in b.column("detections").to_pylist()]


def test_every_rule_fires_on_its_examples():
    for rule in licenses.RULES:
        texts = examples(rule.pattern)
        lost = [t for t, d in zip(texts, detections(texts, [rule]), strict=True) if not d]
        assert not lost, (rule, lost[:3])


@pytest.mark.parametrize(
    ("said", "label"),
    [
        ("Licensed as GPLv2.", "gpl"),
        ("GPLv3", "gpl"),
        ("LGPLv3+", "lgpl-3.0"),
        ("the LGPLv2.1", "lgpl-2.1"),
        ("AGPLv3", "agpl-3.0"),
        ("under 0BSD", "0bsd"),
        ("the Beerware License", "beerware"),
        ("BigScience Open RAIL-M", "openrail"),
        ("Public Domain Dedication and License", "pddl"),
        ("Creative Commons Zero", "cc0"),
        ("No part of this publication may be reproduced", "proprietary"),
    ],
)
def test_labels_that_a_keyword_kept_out(said, label):
    assert label in [d["label"] for d in detections([said], licenses.RULES)[0]]
