"""Zero-shot classification with an injected scorer that each worker loads once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Category -> the description that a scorer compares a text with. A category with None is known but never offered.
CONTENT_TYPE = {
    "pain_point": "A complaint: something is hard, annoying or does not work for the writer.",
    "unmet_need": "Something is missing or not good enough, which leaves room for improvement.",
    "observation": "An outside view of a trend or of troubles that others have.",
    "discussion": "Opinions and insights meant to start a talk or to teach.",
    "showcase": "A presentation of a product, a project or a success.",
    "none": "None of these: jokes, spam, off topic, or talk about the forum.",
    "advice_seeking": "The writer has a problem or a choice to make and asks for advice.",
    "inquiry": None,
}
SOFTWARE_ROLE = {
    "seeking_software": "The writer searches for a program for some task.",
    "using_software": "The writer tells of using a program to get something done.",
    "software_is_problem": "A program itself fails or annoys the writer.",
    "software_element": "A program is one part of a larger problem or solution.",
    "software_mentioned": "A program is named only in passing.",
    "software_discussion": "The text is about programs in general, their trends or features.",
    "none": "No program plays any part.",
}
EXTERNAL_ROLE = {
    "seeking_external": "The writer asks people or institutions outside for help.",
    "using_external": "The writer makes use of a service or institution outside.",
    "external_is_problem": "Someone or something outside causes the problem.",
    "external_element": "Someone outside contributes to a larger matter.",
    "market_economy_problem": "Markets, policy or the economy cause the problem.",
    "personal_problem": "The trouble is personal and comes from the writer's own situation.",
    "external_mentioned": "Someone outside is named only in passing.",
    "external_discussion": "The text discusses institutions in general.",
    "none": "No one outside plays any part.",
}
TASKS = {"content_type": CONTENT_TYPE, "software_role": SOFTWARE_ROLE, "external_role": EXTERNAL_ROLE}

#: (text, descriptions) -> a score for each description.
Scorer = Callable[[str, Sequence[str]], Sequence[float]]


def word_overlap() -> Scorer:
    """A scorer without a model, for tests and for runs without one: shared words, smoothed to a distribution."""

    def score(text: str, descriptions: Sequence[str]) -> list[float]:
        mine = set(text.lower().split())
        raw = [1.0 + len(mine & set(d.lower().split())) for d in descriptions]
        return [x / sum(raw) for x in raw]

    return score


def zero_shot(text: Column, task: str, load: Callable[[], Scorer] = word_overlap) -> Column:
    """struct<choice, score, meta>: the best category, its score, and all scores. Blank texts: null, 0.0, no scores."""
    offered = {c: d for c, d in TASKS[task].items() if d}
    state: dict[str, Scorer] = {}

    def run(texts: pa.Array) -> pa.Array:
        if "scorer" not in state:
            state["scorer"] = load()
        rows = []
        for t in texts.to_pylist():
            t = (t or "").strip()
            if not t:
                rows.append({"choice": None, "score": 0.0, "meta": []})
                continue
            ranked = sorted(zip(offered, state["scorer"](t, list(offered.values()))), key=lambda x: -x[1])
            rows.append({"choice": ranked[0][0], "score": float(ranked[0][1]), "meta": [(c, float(s)) for c, s in ranked]})
        return pa.array(rows, pa.struct([("choice", pa.string()), ("score", pa.float64()), ("meta", pa.map_(pa.string(), pa.float64()))]))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<choice:string,score:double,meta:map<string,double>>")(text)


class Backend:
    """predict and fit over lists of tasks, for a labelling interface; fit changes nothing."""

    def __init__(self, task: str, load: Callable[[], Scorer] = word_overlap, field: str = "body"):
        self.task, self.load, self.field, self.scorer = task, load, field, None

    def predict(self, tasks: Sequence[dict], **_: object) -> list[dict]:
        self.scorer = self.scorer or self.load()
        offered = {c: d for c, d in TASKS[self.task].items() if d}
        out = []
        for t in tasks:
            text = (t.get("data", {}).get(self.field) or "").strip()
            if not text:
                out.append({"result": [], "score": 0.0})
                continue
            ranked = sorted(zip(offered, self.scorer(text, list(offered.values()))), key=lambda x: -x[1])
            choice = {"from_name": self.task, "to_name": self.field, "type": "choices", "value": {"choices": [ranked[0][0]]}, "meta": dict(ranked)}
            out.append({"result": [choice], "score": float(ranked[0][1])})
        return out

    def fit(self, *_: object, **__: object) -> dict:
        return {}
