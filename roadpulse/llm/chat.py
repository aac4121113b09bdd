"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A conversation is read as a transcript: the lines of its turns in order. Hidden states are roles. What is seen of a line is
the role its speaker marker names, if any, and features of the line (length, question mark, first of the conversation, and
the like). A line that begins a turn or carries a marker may change the role, by learned transition chances; any other
line keeps it. Counts for all chances come from labelled turns of every conversation that is not held out.

Viterbi is a product of small matrices under (max, +), which may be bracketed at will. So a long conversation is cut into
blocks of turns: each block gives its matrix of best scores from entering role to leaving role, the blocks of a
conversation are walked forward and back over these matrices only, and each block then finds its own path between known
ends. No task needs a whole conversation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ["system", "user", "assistant"]
BLOCK_TURNS = 512
#: Speaker markers at the start of a line, by role.
MARKERS = {
    "system": "system|instructions?|système|sistema",
    "user": "user|human|customer|question|q|prompter|nutzer|benutzer|frage|utilisateur|usuario|pregunta",
    "assistant": "assistant|ai|bot|answer|a|agent|gpt|model|antwort|assistent|réponse|asistente|respuesta",
}
MARKER = re.compile("|".join(rf"(?P<{r}>(?:<\|(?:{n})\|>|\[(?:{n})\]|#{{1,4}}\s*(?:{n})\s*:?|\**(?:{n})\**\s*[:>]\**))" for r, n in MARKERS.items()), re.IGNORECASE)
LENGTHS = np.array([1, 20, 40, 80, 160, 240, 320, 480, 640, 960, 1280, 2560])
FEATURES = {"marker": len(ROLES) + 1, "length": len(LENGTHS) + 1, "turn_length": len(LENGTHS) + 1, "asks": 2, "place": 4, "lines": 4, "list": 2}
STARTS = len(ROLES)


def split_lines(text: str) -> list[tuple[str, int, str]]:
    """(line without marker, role number its marker names or -1, marker) of each line of a turn."""
    out = []
    for line in text.split("\n"):
        m = MARKER.match(line.lstrip())
        out.append((line.lstrip()[m.end() :].lstrip(), ROLES.index(m.lastgroup), m[0]) if m else (line, -1, ""))
    return out


def turn_features(text: str, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line, whether it may change the role) of a turn; feature values are small numbers."""
    lines = split_lines(text)
    rows = np.empty((len(lines), len(FEATURES)), dtype=np.int64)
    opens = np.zeros(len(lines), dtype=bool)
    total = int(np.searchsorted(LENGTHS, len(text), side="right"))
    for i, (line, role, _) in enumerate(lines):
        opens[i] = i == 0 or role >= 0
        place = (0 if first else 1) if i == 0 else 2 if i + 1 < len(lines) else 3
        rows[i] = (role + 1, int(np.searchsorted(LENGTHS, len(line), side="right")), total, line.rstrip().endswith("?"), place,
                   min(len(lines), 4) - 1, line.lstrip()[:1] in ("-", "*", "•"))
    return rows, opens


@dataclass
class Hmm:
    """Log chances: of a role at the start, of a role after another at an opening line, of each feature value by role."""

    start: np.ndarray
    change: np.ndarray
    seen: dict[str, np.ndarray]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Log chance of each line (rows) for each role (columns)."""
        return sum(self.seen[f][rows[:, i]] for i, f in enumerate(FEATURES))


def fit(turns: DataFrame) -> Hmm:
    """The model of labelled turns (conv_id, turn, role, text); rows of other roles or without a text or place teach nothing.

    Sums over all given rows, made per batch before the shuffle; what reaches the driver is one row per count of the model.
    """
    rows = turns.filter(F.col("role").isin(ROLES) & F.col("text").isNotNull() & F.col("turn").isNotNull() & F.col("conv_id").isNotNull())

    def count(batches):
        for pdf in batches:
            totals = {f: np.zeros((n, len(ROLES)), dtype=np.int64) for f, n in FEATURES.items()}
            for role, text, turn in zip(pdf["role"], pdf["text"], pdf["turn"]):
                seen, _ = turn_features(text, turn == 0)
                for i, f in enumerate(FEATURES):
                    np.add.at(totals[f][:, ROLES.index(role)], seen[:, i], 1)
            out = [(f, v, r, int(n)) for f, t in totals.items() for (v, r), n in np.ndenumerate(t) if n]
            yield pd.DataFrame(out, columns=["what", "v", "r", "n"])

    seen = rows.select("role", "text", "turn").mapInPandas(count, "what string, v int, r int, n long")
    number = F.element_at(F.create_map(*[x for i, r in enumerate(ROLES) for x in (F.lit(r), F.lit(i))]), F.col("role"))
    steps = rows.select("conv_id", F.col("turn").alias("turn"), number.alias("r"))
    before = steps.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("r").alias("v"))
    moves = steps.join(before, ["conv_id", "turn"], "left").select(
        F.lit("change").alias("what"), F.coalesce("v", F.lit(STARTS)).alias("v"), "r").groupBy("what", "v", "r").agg(F.count(F.lit(1)).alias("n"))
    counts = seen.groupBy("what", "v", "r").agg(F.sum("n").alias("n")).union(moves).collect()

    def chances(what: str, size: int) -> np.ndarray:
        table = np.full((size, len(ROLES)), 0.5)
        for row in counts:
            if row["what"] == what:
                table[row["v"], row["r"]] += row["n"]
        return table

    change = chances("change", len(ROLES) + 1)
    change = np.log(change / change.sum(axis=1, keepdims=True))
    seen_log = {f: np.log((t := chances(f, n)) / t.sum(axis=0)) for f, n in FEATURES.items()}
    # A marker that names a role is trusted even where the labelled turns carry none.
    trust = np.where(np.eye(len(ROLES), dtype=bool), np.log(0.9), np.log(0.05))
    seen_log["marker"][1:] = np.maximum(seen_log["marker"][1:], trust) if _has_markers(counts) else trust
    return Hmm(change[STARTS], change[:STARTS], seen_log)


def _has_markers(counts) -> bool:
    return any(r["what"] == "marker" and r["v"] > 0 for r in counts)


def block_steps(hmm: Hmm, texts: list[str], firsts: list[bool]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(scores, openings, number of lines of each turn) of a run of turns."""
    made = [turn_features(t, f) for t, f in zip(texts, firsts)]
    return hmm.scores(np.concatenate([m[0] for m in made])), np.concatenate([m[1] for m in made]), [len(m[1]) for m in made]


def forward(hmm: Hmm, scores: np.ndarray, opens: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi from scores per entering role; (scores per leaving role, best previous role of each line)."""
    k = len(ROLES)
    back = np.empty((len(scores), k), dtype=np.int8)
    total = begin
    for i in range(len(scores)):
        if opens[i]:
            ways = total[:, None] + hmm.change
            back[i] = ways.argmax(axis=0)
            total = ways.max(axis=0) + scores[i]
        else:
            back[i] = np.arange(k)
            total = total + scores[i]
    return total, back


def block_matrix(hmm: Hmm, scores: np.ndarray, opens: np.ndarray, starts: bool) -> np.ndarray:
    """Best score from each entering role (rows) to each leaving role (columns); the first block is entered from the start."""
    k = len(ROLES)
    if starts:
        total, _ = forward(hmm, scores[1:], opens[1:], hmm.start + scores[0])
        return np.tile(total, (k, 1))
    out = np.empty((k, k))
    for r in range(k):
        begin = np.full(k, -np.inf)
        begin[r] = 0.0
        out[r] = forward(hmm, scores, opens, begin)[0]
    return out


def ends_of_blocks(matrices: np.ndarray) -> list[int]:
    """The leaving role of each block of one conversation, by a walk forward and back over the block matrices."""
    total, back = matrices[0][0], []
    for m in matrices[1:]:
        ways = total[:, None] + m
        back.append(ways.argmax(axis=0))
        total = ways.max(axis=0)
    ends = [int(total.argmax())]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    return ends[::-1]


def block_path(hmm: Hmm, scores: np.ndarray, opens: np.ndarray, entered: int, end: int) -> np.ndarray:
    """The role of each line of a block between known ends; ``entered`` is -1 in the first block."""
    k = len(ROLES)
    if entered < 0:
        _, back = forward(hmm, scores[1:], opens[1:], hmm.start + scores[0])
        back = np.vstack([np.zeros((1, k), dtype=np.int8), back])
    else:
        begin = np.full(k, -np.inf)
        begin[entered] = 0.0
        _, back = forward(hmm, scores, opens, begin)
    path = np.empty(len(scores), dtype=np.int64)
    path[-1] = end
    for i in range(len(scores) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def rendered(segments: list[tuple[int, str]]) -> str:
    """Canonical turns: a header with the role, the text, an end mark."""
    return "".join(f"<|im_start|>{ROLES[r]}\n{text}<|im_end|>\n" for r, text in segments)


def format_turns(turns: DataFrame, hmm: Hmm) -> DataFrame:
    """One row per turn: conv_id, turn, role_pred (of its first line), n_segments, rendered (canonical text).

    A turn in which a marker changes the role gives several segments. Null text counts as empty (one empty line). Turns are
    ordered by their number, equal numbers by their text; a null number comes first, and rows of a null conversation are
    read as one conversation. Repeated rows are turns of their own.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK_TURNS)).withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")))
    first = rows.groupBy("conv").agg(F.min("block").alias("first_block"))

    def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.sort_values(["turn", "text"], na_position="first", kind="stable")

    def steps_of(pdf: pd.DataFrame, starts: bool):
        return block_steps(hmm, pdf["text"].tolist(), [starts and i == 0 for i in range(len(pdf))])

    def matrix(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = ordered(pdf)
        starts = bool(pdf["block"].iloc[0] == pdf["first_block"].iloc[0])
        scores, opens, _ = steps_of(pdf, starts)
        return pd.DataFrame({"conv": [pdf["conv"].iloc[0]], "block": [int(pdf["block"].iloc[0])], "m": [block_matrix(hmm, scores, opens, starts).ravel().tolist()]})

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        ends = ends_of_blocks(np.array(pdf["m"].tolist()).reshape(-1, len(ROLES), len(ROLES)))
        return pd.DataFrame({"conv": pdf["conv"], "block": pdf["block"], "entered": [-1, *ends[:-1]], "leaves": ends})

    def paths(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = ordered(pdf)
        entered = int(pdf["entered"].iloc[0])
        scores, opens, sizes = steps_of(pdf, entered < 0)
        path = block_path(hmm, scores, opens, entered, int(pdf["leaves"].iloc[0]))
        out, at = [], 0
        for text, size in zip(pdf["text"], sizes):
            segments: list[tuple[int, list[str]]] = []
            for (line, role, _), r in zip(split_lines(text), path[at : at + size].tolist()):
                if not segments or segments[-1][0] != r or role >= 0:
                    segments.append((r, []))
                segments[-1][1].append(line)
            out.append((ROLES[segments[0][0]], len(segments), rendered([(r, "\n".join(x)) for r, x in segments])))
            at += size
        made = pd.DataFrame(out, columns=["role_pred", "n_segments", "rendered"], index=pdf.index)
        return pd.concat([pdf[["conv_id", "turn"]], made], axis=1)

    blocked = rows.join(first, "conv")
    kind = turns.schema["conv_id"].dataType.simpleString()
    matrices = blocked.groupBy("conv", "block").applyInPandas(matrix, "conv string, block long, m array<double>")
    walked = matrices.groupBy("conv").applyInPandas(walk, "conv string, block long, entered int, leaves int")
    return rows.join(walked, ["conv", "block"]).groupBy("conv", "block").applyInPandas(
        paths, f"conv_id {kind}, turn long, role_pred string, n_segments int, rendered string")
