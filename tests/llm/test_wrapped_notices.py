import math
import re
import textwrap

import pytest
from llm_samples import ODD, docs, found

from cohortair.llm import licenses

NOTICES = [
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted",
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.",
    "Unless required by applicable law or agreed to in writing, software\n"
    'distributed under the License is distributed on an "AS IS" BASIS,',
    "All\nrights\r\n\r\nreserved",
]
LABELS = ["bsd", "mpl", "apache", "all-rights-reserved"]


def all_runs(text, containment):
    """Labels and best score by every line and every run of words."""
    split = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    words, labels, best = split(text or ""), set(), 0.0
    for notice in licenses.TEMPLATES:
        parts = notice.text.split(" ")
        need = math.ceil(containment * len(set(parts)) - 1e-9)
        sets = [split(line) for line in (text or "").split("\n")]
        sets += [words[i : i + len(parts)] for i in range(len(words))]
        most = max((len(set(parts) & set(s)) for s in sets), default=0)
        if most >= need:
            labels.add(notice.label)
            best = max(best, most / len(set(parts)))
    return labels, best


@pytest.mark.parametrize("containment", [0.5, 0.8, 1.0])
def test_wrapped_notices_equal_all_runs(spark, containment):
    texts = list(NOTICES)
    for notice in licenses.TEMPLATES:
        for width in (60, 70, 80):
            for ahead in (0, 7, 24, 25, 26, 49, 50, 51):
                texts.append(textwrap.fill("filler " * ahead + notice.text + " and the end of it", width))
        texts.append(" gap ".join(notice.text.split(" ")))
        texts.append("\n".join(notice.text.split(" ")[::-1]))
    rows = [*[(i, t) for i, t in ODD if i != 9], *((100 + i, t) for i, t in enumerate(texts))]
    made = licenses.license_scan(docs(spark, rows), phrases=licenses.PHRASES[:1], containment=containment)
    expected = []
    for i, text in rows:
        labels, best = all_runs(text, containment)
        base = "gnu general public license" in re.sub(r"[^a-z0-9]+", " ", (text or "").lower())
        expected.append((i, ",".join(sorted(labels | ({"gpl"} if base else set()))), 1.0 if base else best))
    assert found(made, "doc_id", "labels", "score") == sorted(expected, key=lambda r: tuple(map(str, r)))


def test_wrapped_notices_are_labelled(spark):
    made = licenses.license_scan(docs(spark, list(enumerate(NOTICES))))
    assert found(made, "doc_id", "labels", "score") == [(i, label, 1.0) for i, label in enumerate(LABELS)]
