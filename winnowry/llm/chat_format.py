"""Operator 3: chat formatting by a hidden Markov model over lines.

A transcript is plain text in which speakers are marked in many ways ("User:", "[ASSISTANT]", "**Human**:", "Q:",
"<|system|>") or, here and there, not at all. Each line emits a marker class, whether a blank line came before it, a
class of length and a class of its ending. The states are role x (first line of a turn, later line). Counts of
transitions and emissions over all labelled transcripts, plus one, give the model; Viterbi in logarithms recovers the
most probable states, for all transcripts of a batch side by side. Turns are then rendered in one canonical form,
``<|role|>`` newline text newline ``<|end|>`` newline, without their markers.

The query makes transcripts of ``conversations``: the style of markers depends on the conversation, and by a hash one
turn in seven has none. The model is counted on them with the known roles, and the roles are recovered from text alone.

Defined results: null and blank transcripts have no turns and render as ''. Null texts and roles in ``conversations``
count as an empty text and as user; equal turn numbers are ordered by role and text. A null conv_id names no conversation:
each of its turns is a transcript of its own (equal ones together). Repeated rows are repeated turns. Of paths that are
equally probable the one with the first states is taken. An empty table gives an empty result. A transcript is one text,
so all turns of a conversation meet in one row; very long lines and texts are handled whole. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
NAMES = {
    "system": ("system", "sys", "instruction", "instructions", "s"),
    "user": ("user", "human", "question", "customer", "me", "q", "u"),
    "assistant": ("assistant", "ai", "bot", "answer", "agent", "model", "gpt", "a"),
}
_ROLE_OF = {n: k for k, r in enumerate(ROLES) for n in NAMES[r]}
MARKER = re.compile(
    r"\s*(?:"
    r"<\|(?:im_start\|>)?\s*([A-Za-z]+)(?:\|>)?\s*:?|"  # <|user|>
    r"\[/?([A-Za-z]+)\]\s*:?|"  # [USER]
    r"\*\*\s*([A-Za-z]+)\s*:?\s*\*\*\s*:?|"  # **User**:
    r"#{1,6}\s*([A-Za-z]+)\s*:?\s*$|"  # ### User
    r"([A-Za-z]+)\s*(?:\(\d[^)]*\))?\s*:(?=\s|$)"  # User:
    r")\s*"
)
#: Sizes of the emissions: marker (none, the three roles, another name), blank line before, length, ending.
SIZES = (5, 2, 6, 4)
STATES = 2 * len(ROLES)


def markers(line: str) -> tuple[int, int]:
    """The marker class of a line, and how many characters the marker takes."""
    m = MARKER.match(line)
    if not m:
        return 0, 0
    k = _ROLE_OF.get(next(g for g in m.groups() if g).lower())
    return (4, 0) if k is None else (k + 1, m.end())


def lines_of(text: str) -> tuple[list[str], np.ndarray, list[int]]:
    """The lines that aren't blank, their emissions, and the lengths of their markers."""
    lines, rows, cuts = [], [], []
    blank = 0
    for line in text.split("\n"):
        if not line.strip():
            blank = 1
            continue
        mark, cut = markers(line)
        n = len(line) - cut
        end = line.rstrip()[-1]
        rows.append((mark, blank, min(5, n // 40 if n < 160 else 4 + (n >= 400)), ".?:".find(end) + 1))
        lines.append(line)
        cuts.append(cut)
        blank = 0
    return lines, np.array(rows, np.int64).reshape(-1, len(SIZES)), cuts


class Hmm:
    """Logarithms of start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]):
        self.start = np.log((start + 1.0) / (start + 1.0).sum())
        self.move = np.log((move + 1.0) / (move + 1.0).sum(axis=1, keepdims=True))
        self.emit = [np.log((e + 1.0) / (e + 1.0).sum(axis=1, keepdims=True)) for e in emit]

    def viterbi(self, seqs: list[np.ndarray]) -> list[np.ndarray]:
        """The best states of each sequence of emissions; all sequences advance together, longest first."""
        order = sorted(range(len(seqs)), key=lambda k: -len(seqs[k]))
        size = np.array([len(seqs[k]) for k in order])
        if not len(size) or not size[0]:
            return [np.zeros(0, np.int64) for _ in seqs]
        score = [sum(self.emit[f].T[seqs[k][:, f]] for f in range(len(SIZES))) for k in order]
        live = int((size > 0).sum())
        v = np.stack([score[k][0] for k in range(live)]) + self.start
        back: list[np.ndarray] = []
        last = np.zeros((len(size), STATES))
        for t in range(1, size[0]):
            now = int((size > t).sum())
            last[now : len(v)] = v[now:]
            options = v[:now, :, None] + self.move
            best = options.argmax(axis=1)
            back.append(best)
            v = np.take_along_axis(options, best[:, None, :], 1)[:, 0] + np.stack([score[k][t] for k in range(now)])
        last[: len(v)] = v
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(seqs)
        for k, o in enumerate(order):
            path = np.zeros(size[k], np.int64)
            if size[k]:
                path[-1] = last[k].argmax()
                for t in range(size[k] - 1, 0, -1):
                    path[t - 1] = back[t - 1][k][path[t]]
            out[o] = path
        return out


def turns_of(lines: list[str], cuts: list[int], states: np.ndarray) -> list[tuple[str, str]]:
    """(role, text) by turn: a first-line state or a change of role begins one."""
    out: list[tuple[str, list[str]]] = []
    for line, cut, s in zip(lines, cuts, states.tolist()):
        role = ROLES[s // 2]
        if not out or s % 2 == 0 or out[-1][0] != role:
            out.append((role, []))
        out[-1][1].append(line[cut:].strip() if cut else line.strip())
    return [(r, "\n".join(x for x in t if x)) for r, t in out]


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in turns)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (table, row, column): table 0 the start, 1 transitions, 2 and on the emissions."""
    start, move = np.zeros(STATES, np.int64), np.zeros((STATES, STATES), np.int64)
    emit = [np.zeros((STATES, n), np.int64) for n in SIZES]
    for batch in batches:
        for turns in batch.column(0).to_pylist():
            path, rows = [], []
            for x in turns:
                lines, e, _ = lines_of(x["raw"])
                k = ROLES.index(x["role"]) if x["role"] in ROLES else 1
                path += [2 * k + (j > 0) for j in range(len(lines))]
                if len(e) and rows:
                    e[0, 1] = 1
                rows += list(e)
            if path:
                p = np.array(path)
                start[p[0]] += 1
                np.add.at(move, (p[:-1], p[1:]), 1)
                for f, c in enumerate(emit):
                    np.add.at(c, (p, np.array(rows)[:, f]), 1)
    for k, t in enumerate([start[None], move, *emit]):
        i, j = np.nonzero(t)
        yield pa.RecordBatch.from_arrays([pa.array([k] * len(i), pa.int32()), pa.array(i), pa.array(j), pa.array(t[i, j])], ["t", "i", "j", "n"])


def train(labelled: DataFrame) -> Hmm:
    """From a column ``turns``: array<struct<role, raw>>; the sums have a fixed number of rows."""
    # Beside one of everything, a few counts say what holds for any transcripts: turns go on, first lines have markers.
    rows = labelled.select("turns").mapInArrow(_count, "t int, i bigint, j bigint, n bigint").groupBy("t", "i", "j").agg(F.sum("n").alias("n")).collect()
    start, move = np.zeros(STATES), np.zeros((STATES, STATES))
    emit = [np.zeros((STATES, n)) for n in SIZES]
    tables = [start[None], move, *emit]
    for r in rows:
        tables[r["t"]][r["i"], r["j"]] = r["n"]
    for k in range(len(ROLES)):
        move[2 * k : 2 * k + 2, 2 * k + 1] += 10
        emit[0][2 * k, k + 1] += 10
        emit[0][2 * k + 1, 0] += 10
        emit[1][2 * k, 1] += 10
        emit[1][2 * k + 1, 0] += 10
    return Hmm(start, move, emit)


def parse(text: Column, hmm: Hmm) -> Column:
    """struct<roles, rendered> of a transcript column."""

    def run(texts: pa.Array) -> pa.Array:
        parts = [lines_of(t.as_py() or "") for t in texts]
        paths = hmm.viterbi([e for _, e, _ in parts])
        turns = [turns_of(lines, cuts, p) for (lines, _, cuts), p in zip(parts, paths)]
        return pa.StructArray.from_arrays(
            [pa.array([[r for r, _ in t] for t in turns], pa.list_(pa.string())), pa.array([render(t) for t in turns], pa.string())], ["roles", "rendered"]
        )

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<roles:array<string>,rendered:string>").asNondeterministic()(text)


#: Marker styles of the query's transcripts: prefixes for system, user, assistant.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("SYSTEM: ", "Human: ", "AI: "),
    ("[SYSTEM] ", "[USER] ", "[ASSISTANT] "),
    ("**System**: ", "**User**: ", "**Assistant**: "),
    ("<|system|> ", "<|user|> ", "<|assistant|> "),
    ("S: ", "Q: ", "A: "),
)


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns: array<struct<role, raw>>, text) in marked plain text, turns parted by blank lines."""
    role = F.when(F.lower("role").isin(*ROLES), F.lower("role")).otherwise("user")
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    bare = F.pmod(F.xxhash64("conv_id", "turn", F.lit("bare")), F.lit(7)) == 0
    prefix = F.array(*[F.array(*[F.lit(x) for x in s]) for s in STYLES])[style.cast("int")]
    at = F.when(role == "system", 0).when(role == "user", 1).otherwise(2)
    text = F.coalesce("text", F.lit(""))
    turn = conversations.select("conv_id", F.struct("turn", role.alias("role"), F.when(bare, text).otherwise(F.concat(prefix[at], text)).alias("raw")).alias("t"))
    packed = turn.groupBy("conv_id", F.when(F.col("conv_id").isNull(), F.struct("t.turn", "t.role", "t.raw")).alias("alone")).agg(F.array_sort(F.collect_list("t")).alias("t"))
    turns = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["raw"].alias("raw")))
    return packed.select("conv_id", turns.alias("turns"), F.array_join("t.raw", "\n\n").alias("text"))


def chat_format(made: DataFrame, hmm: Hmm, id_col: str = "conv_id", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, roles, rendered) of every transcript."""
    out = made.select(made[id_col].alias("conv_id"), parse(made[text_col], hmm).alias("p"))
    return out.select("conv_id", F.size("p.roles").cast("long").alias("n_turns"), "p.roles", "p.rendered")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transcripts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat_format(made, train(made))
