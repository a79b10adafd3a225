"""Transcript parsing by a hidden Markov model (operator 7).

A transcript comes as rows (conv_id, turn, text) without roles. Its lines are the model's observations: speaker marker, length, place in
the row, question mark, list or code look. Roles are the hidden states. A line that starts a row or bears a marker moves by the
turn transitions, other lines stay with their speaker. Probabilities come from counts over labelled rows with Dirichlet priors, whose
weight makes markers count where no labelled row has any. Viterbi's algorithm recovers the roles; turns are then rendered in one form.

Text that is in that form already (<|im_start|> and <|im_end|>) is certain: a mark names its role, and the lines up to its end belong to it,
whatever markers they bear. Marks within a turn's text are escaped by a backslash when it is rendered, and restored when
it is parsed, so that no text can forge a turn and rendered turns parse to themselves.

A conversation may hold any share of all rows: rows are dealt out by ranges of (conv_id, turn), so that a long one lies in several
partitions. Each partition gives, for its first and last conversation, the best log-probability from every state at its border to every
state at its end, and the driver joins these few matrices to fix the states at the borders. Within them each partition decodes by
itself. That is exact: maximisation over paths is associative.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm.common import cut, fold, small_batches, table, texts_of

ROLES = ("system", "user", "assistant", "tool")
#: Names that speakers go by.
ALIASES = {
    "system": "system", "instruction": "system", "instructions": "system", "context": "system",
    "user": "user", "human": "user", "prompter": "user", "customer": "user", "client": "user", "q": "user", "question": "user", "you": "user", "me": "user", "interviewer": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "chatbot": "assistant", "model": "assistant", "agent": "assistant", "gpt": "assistant", "a": "assistant", "answer": "assistant", "response": "assistant",
    "tool": "tool", "function": "tool", "observation": "tool",
}
NO_MARKER, NAMED = len(ROLES), len(ROLES) + 1
#: Counts that the priors are worth: of any feature value, of a marker that names its role, of a line's staying with its speaker.
SMOOTH, MARKER, STAY = 0.5, 200.0, 1000.0
#: Log-probability of what is as good as impossible.
SURE = -1e9
RENDERED = "<|im_start|>{role}\n{text}<|im_end|>\n"

_CHATML = re.compile(r"\s*<\|(?:im_start|start_header_id)\|>\s*(\w+)\s*(?:<\|end_header_id\|>)?\s*(.*)", re.S)
_END = re.compile(r"\s*<\|(?:im_end|eot_id)\|>\s*\Z")
_SPEAKER = re.compile(r"\s*[\[(<#*>_|-]*\s*([A-Za-z][\w.'-]{0,23}(?: [A-Z0-9][\w.'-]{0,15})?)\s*(?:\([^)]{1,20}\))?\s*[\])>*_|]*\s*[:：][*_]*(?:\s+|$)(.*)", re.S)
_LIST = re.compile(r"\s*(?:[-*•]|\d+[.)])\s")
_CODE = re.compile(r"```|^(?: {4}|\t)|[{};]\s*$")


def mark(line: str) -> re.Match | None:
    """The mark that a line starts a turn with: a role, or a name with nothing behind it."""
    m = _CHATML.match(line)
    return m if m and (m[1].lower() in ALIASES or not m[2].strip()) else None


def marker(line: str) -> tuple[int, str]:
    """The marker that a line begins with (a role's index, NAMED for another speaker's name, NO_MARKER) and the rest of the line."""
    if m := mark(line):
        role = ALIASES.get(m[1].lower())
        return (ROLES.index(role) if role else NAMED), m[2]
    if ":" in line or "：" in line:
        if m := _SPEAKER.match(line):
            role = ALIASES.get(m[1].lower())
            if role:
                return ROLES.index(role), m[2]
            if m[1][0].isupper() and not m[2].startswith("//"):
                return NAMED, m[2]
    return NO_MARKER, line


#: Feature names and how many values each has.
FEATURES = {"marker": len(ROLES) + 2, "first": 2, "length": 14, "row": 18, "question": 2, "look": 3}


#: Column of the features that says what is certain of a line: nothing, that it stays with its speaker, or (BOUND + role) its role.
CERTAIN, BOUND = len(FEATURES), 2


def escape(text: str) -> str:
    """Text whose marks are none: each <| gets a backslash more."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def observe(text: str | None) -> tuple[list[str], np.ndarray]:
    """Lines of a row without their markers, and the features of each (a row of small numbers); an empty row is one empty line."""
    lines = re.sub(r"(<\|(?:im_end|eot_id)\|>)[ \t]*(?=<\|(?:im_start|start_header_id)\|>)", "\\1\n", text or "").split("\n")
    size = min(17, len(text or "").bit_length())
    rest, out = [], np.empty((len(lines), len(FEATURES) + 1), dtype=np.int64)
    within = ended = False
    for i, line in enumerate(lines):
        certain = 0
        if mark(line):
            kind, plain = marker(line)
            certain = BOUND + kind if kind < NO_MARKER else 0
            within = True
        elif within:
            kind, plain, certain = NO_MARKER, line, 1
        else:
            kind, plain = marker(line)
            certain = int(ended and not line.strip())  # nothing follows an ended turn
        if end := _END.search(plain):
            plain = plain[: end.start()]
        rest.append(unescape(plain) if within else plain)
        ended = bool(end and within) or (ended and not line.strip())
        within = within and not end
        look = 1 if _LIST.match(plain) else 2 if _CODE.search(plain) else 0
        out[i] = (kind, i == 0, min(13, len(plain).bit_length()), size if i == 0 else 0, plain.rstrip().endswith("?"), look, certain)
    return rest, out


@dataclass
class Model:
    """Logarithms of probabilities: start (role), turn (from, to), stay (from, to), and per feature (value, role)."""

    start: np.ndarray
    turn: np.ndarray
    stay: np.ndarray
    emit: list[np.ndarray]

    def scores(self, features: np.ndarray) -> np.ndarray:
        """(line, role): log-probability of each line's features; a mark's role is as good as certain."""
        other = (features[:, CERTAIN, None] >= BOUND) & (features[:, CERTAIN, None] != BOUND + np.arange(len(ROLES)))
        return sum(table[features[:, k]] for k, table in enumerate(self.emit)) + other * SURE

    def moves(self, features: np.ndarray) -> np.ndarray:
        """(line, from, to): turn transitions where a row starts or a marker stands, else the others."""
        turns = (features[:, 1] == 1) | (features[:, 0] != NO_MARKER)
        bound = (features[:, CERTAIN] == 1)[:, None, None]
        return np.where(bound, (1 - np.eye(len(ROLES))) * SURE, np.where(turns[:, None, None], self.turn, self.stay))


def model_of(counts: Counter) -> Model:
    """From counts of ("start", role), ("turn", from, to), (feature, value, role)."""
    n = len(ROLES)
    start = np.array([counts["start", r] + SMOOTH for r in range(n)])
    turn = np.array([[counts["turn", a, b] + SMOOTH for b in range(n)] for a in range(n)])
    stay = np.eye(n) * STAY + SMOOTH
    emit = []
    for name, size in FEATURES.items():
        c = np.array([[counts[name, v, r] + SMOOTH for r in range(n)] for v in range(size)], dtype=float)
        if name == "marker":
            c[range(n), range(n)] += MARKER
            c[NO_MARKER] += MARKER
            c[NAMED] += MARKER / 4
        emit.append(np.log(c / c.sum(axis=0)))
    return Model(np.log(start / start.sum()), np.log(turn / turn.sum(axis=1, keepdims=True)), np.log(stay / stay.sum(axis=1, keepdims=True)), emit)


def reach(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """(state before the first line, state at the last): the best log-probability of any path."""
    best = moves[0] + scores[0]
    for s, m in zip(scores[1:], moves[1:], strict=True):
        best = (best[:, :, None] + m[None]).max(axis=1) + s
    return best


def viterbi(scores: np.ndarray, moves: np.ndarray, first: np.ndarray, last: int | None = None) -> list[int]:
    """The best states of lines, given log-probabilities `first` of the first line's states, ending in `last` if that is known.

    Of equal paths the one with the smaller states, from the end, wins.
    """
    best, back = first + scores[0], []
    for s, m in zip(scores[1:], moves[1:], strict=True):
        ways = best[:, None] + m
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0) + s
    path = [int(best.argmax()) if last is None else last]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _role(value: str | None) -> int | None:
    role = ALIASES.get((value or "").strip().lower())
    return ROLES.index(role) if role else None


def ordered(rows: DataFrame) -> DataFrame:
    """Rows in order of (conv_id, turn), ties by a hash of the text, dealt out by ranges and written down, with the partition's number."""
    tie = F.xxhash64("text")
    dealt = rows.withColumn("tie", tie).repartitionByRange("conv_id", "turn", "tie").sortWithinPartitions("conv_id", "turn", "tie", "text")
    return cut(dealt.drop("tie").withColumn("part", F.spark_partition_id()))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one partition, and its border rows: (conversation, role) of its first and last one."""
    counts: Counter = Counter()
    before, edge = None, []
    for batch in small_batches(batches, "text"):
        cols = [batch.column(c).to_pylist() for c in ("part", "conv_id", "learn", "role")]
        for text, part, conv, learn, role in zip(texts_of(batch), *cols, strict=True):
            r = _role(role) if learn else None
            now = (part, conv, r)
            if before is None:
                edge.append((part, 0, conv, r))
            elif r is not None:
                if before[1] != conv:
                    counts["start", r] += 1
                elif before[2] is not None:
                    counts["turn", before[2], r] += 1
            before = now
            if r is not None:
                _, seen = observe(text)
                for name, column in zip(FEATURES, seen.T[:CERTAIN], strict=True):
                    values, n = np.unique(column, return_counts=True)
                    for v, c in zip(values.tolist(), n.tolist(), strict=True):
                        counts[name, v, r] += c
    if before is not None:
        edge.append((before[0], 1, before[1], before[2]))
    rows = [("edge", p, e, r, c) for p, e, c, r in edge] + [(k[0], k[1], k[2] if len(k) > 2 else None, None, n) for k, n in counts.items()]
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(("name", "a", "b", "r", "n"), cols, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)})


def fit(rows: DataFrame) -> Model:
    """Learn from ordered rows (part, conv_id, text, role, learn) where learn is true and the role is known."""
    schema = "name string, a long, b long, r long, n long"
    found = rows.mapInArrow(_counts, schema)
    summed = found.where("name != 'edge'").groupBy("name", "a", "b").agg(F.sum("n").alias("n")).collect()  # as many as there are feature values
    counts: Counter = Counter()
    for x in summed:
        key = (x["name"], x["a"]) if x["b"] is None else (x["name"], x["a"], x["b"])
        counts[key] += x["n"]
    # two border rows a partition: the pairs that lie across
    edges = sorted(((x["a"], x["b"], x["n"], x["r"]) for x in found.where("name = 'edge'").collect()), key=lambda x: x[:2])
    previous = None
    for _, end, conv, r in edges:
        if not end and r is not None:
            if previous is None or previous[0] != conv:
                counts["start", r] += 1
            elif previous[1] is not None:
                counts["turn", previous[1], r] += 1
        if end:
            previous = (conv, r)
    return model_of(counts)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(part, conv_id, rows) of each conversation of a partition in order; a row: the other columns and its text."""
    key, rows = None, []
    for batch in small_batches(batches, "text"):
        cols = [batch.column(c).to_pylist() for c in ("part", "conv_id", "turn", "held_out")]
        for part, conv, turn, held, text in zip(*cols, batch.column("text").to_pylist(), strict=True):
            if rows and key[1] != conv:
                yield *key, rows
                rows = []
            key = (part, conv)
            rows.append((turn, held, text))
    if rows:
        yield *key, rows


def _borders(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For the first and the last conversation of a partition the matrix that its lines make there."""
        model: Model = shipped.value
        found: list[tuple] = []
        for part, conv, rows in _conversations(batches):
            if len(found) == 2:
                found.pop()
            found.append((part, conv, rows))
        out = []
        for k, (part, conv, rows) in enumerate(found):
            seen = np.concatenate([observe(text)[1] for _, _, text in rows])
            scores, moves = model.scores(seen), model.moves(seen)
            out.append((part, k, conv, reach(scores, moves).ravel().tolist(), (model.start + scores[0]).tolist(), reach(scores[1:], moves[1:]).ravel().tolist() if len(seen) > 1 else []))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(("part", "nth", "conv_id", "through", "begin", "rest"), cols, kinds, strict=True)})

    return run


def border_states(rows: DataFrame, shipped) -> dict[tuple[int, int | None], tuple[int | None, int]]:
    """For each piece of a conversation that several partitions share: the state before it (None at its start), and its last state."""
    schema = "part long, nth long, conv_id long, through array<double>, begin array<double>, rest array<double>"
    found = sorted(rows.mapInArrow(_borders(shipped), schema).collect(), key=lambda x: (x["part"], x["nth"]))  # two rows a partition
    n = len(ROLES)
    chains: list[list] = []
    for x in found:
        if chains and chains[-1][-1]["conv_id"] == x["conv_id"] and chains[-1][-1]["part"] != x["part"]:
            chains[-1].append(x)
        else:
            chains.append([x])
    out = {}
    for chain in chains:
        if len(chain) < 2:
            continue
        first = np.array(chain[0]["begin"])
        best = first if not chain[0]["rest"] else (first[:, None] + np.array(chain[0]["rest"]).reshape(n, n)).max(axis=0)
        back = []
        for x in chain[1:]:
            ways = best[:, None] + np.array(x["through"]).reshape(n, n)
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0)
        last = int(best.argmax())
        for x, b in zip(reversed(chain[1:]), reversed(back), strict=True):
            out[x["part"], x["conv_id"]] = (int(b[last]), last)
            last = int(b[last])
        out[chain[0]["part"], chain[0]["conv_id"]] = (None, last)
    return out


def _decoded(shipped, borders):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shipped.value
        names = ("conv_id", "turn", "nth", "role", "n_lines", "rendered", "held_out")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_())
        out: list[tuple] = []
        for part, conv, rows in _conversations(batches):
            lines, seen = zip(*(observe(text) for _, _, text in rows), strict=True)
            at = np.cumsum([0, *map(len, lines)]).tolist()
            seen = np.concatenate(seen)
            scores, moves = model.scores(seen), model.moves(seen)
            before, last = borders.value.get((part, conv), (None, None))
            path = viterbi(scores, moves, model.start if before is None else moves[0][before], last)
            for (turn, held, _), own, a in zip(rows, lines, at[:-1], strict=True):
                # a turn within a row: lines up to the next that bears a marker or changes the role
                nth = i = 0
                while i < len(own):
                    j = i + 1
                    while j < len(own) and path[a + j] == path[a + i] and seen[a + j, 0] == NO_MARKER:
                        j += 1
                    role = ROLES[path[a + i]]
                    out.append((conv, turn, nth, role, j - i, RENDERED.format(role=role, text=escape("\n".join(own[i:j]).strip())), held))
                    nth, i = nth + 1, j
            if len(out) >= 2000:
                yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, zip(*out, strict=True), kinds, strict=True)})
                out = []
        cols = list(zip(*out, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, cols, kinds, strict=True)})

    return run


def parse(rows: DataFrame) -> DataFrame:
    """Recovered turns of rows (conv_id, turn, text, role): conv_id, turn, nth (within the row), role, n_lines, rendered, held_out.

    Roles of conversations whose id's crc32 modulo 5 is not 0 are learned from, where they are known; no role is an input of decoding. Null
    and empty texts are one empty line each. A null conv_id makes one conversation of all its rows; a null turn comes first. Rows that
    repeat (conv_id, turn) follow each other in an order that their texts' hashes fix. No rows give no turns. Other columns are ignored.
    """
    sc = rows.sparkSession.sparkContext
    held = fold("conv_id", 5) == 0
    role = F.col("role") if "role" in rows.columns else F.lit(None).cast("string").alias("role")
    plain = ordered(rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "text", role, held.alias("held_out")))
    model = sc.broadcast(fit(plain.withColumn("learn", ~F.col("held_out"))))
    borders = sc.broadcast(border_states(plain, model))  # two entries a partition at most
    return plain.mapInArrow(_decoded(model, borders), "conv_id long, turn long, nth long, role string, n_lines long, rendered string, held_out boolean")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(table(spark, sf_dir, "conversations"))


QUERIES = {"op7_chat": op7}
