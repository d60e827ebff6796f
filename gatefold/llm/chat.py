"""Chat formatting by minimum-cost role repair.

Legal sequences: an optional system turn, then user and assistant in turn, user first, ending with
assistant.  A dynamic programme over that automaton reads a conversation turn by turn; its state is the
role of the last turn written.  For every turn it keeps, relabels or merges the turn into the last one,
after inserting an empty turn where that is cheaper; the cheapest path is rendered.  Ties are
broken by the order keep, merge, relabel, insert, so equal conversations repair equally.

Defined results: turns are ordered by turn number (null first), then role and text; repeated rows are
repeated turns; null text is empty; a null or unknown role has to be relabelled; a turn with a null
conv_id is a conversation of its own; an empty table gives an empty table.  A conversation becomes one
string, so it must fit into one record.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.llm.common import table

ROLES = ("system", "user", "assistant")
#: role of the last written turn -> roles that may follow
NEXT = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
FINAL = "assistant"
#: costs of merging a turn into one of its role, of relabelling, of relabelling to or from system, of an empty turn
MERGE, RELABEL, RELABEL_SYSTEM, INSERT = 1, 5, 6, 3
GLUE, OPEN, CLOSE = "\n\n", "<|im_start|>", "<|im_end|>\n"


def _fills() -> dict[tuple[str | None, str], tuple[str, ...]]:
    """The shortest run of empty turns after which a role may follow a state."""
    out: dict[tuple[str | None, str], tuple[str, ...]] = {}
    for start in NEXT:
        todo: list[tuple[str, ...]] = [()]
        while todo:
            run = todo.pop(0)
            for r in NEXT[run[-1] if run else start]:
                if (start, r) not in out:
                    out[start, r] = run
                if len(run) < 3 and r != "system":
                    todo.append((*run, r))
    return out


FILL = _fills()


def relabel_cost(role: str | None, to: str) -> int:
    if role == to:
        return 0
    return RELABEL_SYSTEM if "system" in (role, to) else RELABEL


def repair(turns: list[tuple[str | None, str]]) -> tuple[int, list[tuple[str, str, str]]]:
    """Cost and repaired turns (role, text, how) of (role, text) turns."""
    if not turns:
        return 0, []
    best: dict[str | None, tuple] = {None: (0, None, None)}  # state -> (cost, previous node, action)
    for i, (role, _) in enumerate(turns):
        now: dict[str | None, tuple] = {}
        for state, node in best.items():
            for to in ROLES:
                change = relabel_cost(role, to)
                options = []
                if (state, to) in FILL:
                    fill = FILL[state, to]
                    options.append((node[0] + change + INSERT * len(fill), ("add", i, to, fill)))
                if to == state:
                    options.append((node[0] + change + MERGE, ("merge", i, to, ())))
                for cost, action in options:
                    rank = (cost, bool(action[3]), action[0] == "merge", change > 0)
                    if to not in now or rank < now[to][3]:
                        now[to] = (cost, node, action, rank)
        best = now
    ends = []
    for state, node in best.items():
        fill = () if state == FINAL else (*FILL[state, FINAL], FINAL)
        ends.append((node[0] + INSERT * len(fill), len(fill), ROLES.index(state), node, fill))
    cost, _, _, node, fill = min(ends, key=lambda x: x[:3])
    path = []
    while node[2]:
        path.append(node[2])
        node = node[1]
    out: list[list] = []
    for kind, i, to, gaps in reversed(path):
        role, text = turns[i]
        out += [[g, [""], "insert"] for g in gaps]
        if kind == "merge":
            out[-1][1].append(text)
            out[-1][2] = "merge"
        else:
            out.append([to, [text], "keep" if role == to else "relabel"])
    out += [[g, [""], "insert"] for g in fill]
    return cost, [(r, GLUE.join(t), how) for r, t, how in out]


def legal(roles: list[str]) -> bool:
    state = None
    for r in roles:
        if r not in NEXT[state]:
            return False
        state = r
    return state == FINAL or not roles


def render(turns: list[tuple[str, str, str]]) -> str:
    """Marker strings inside a text are broken up by a space, so that they can't open or close a turn."""
    return "".join(f"{OPEN}{r}\n{t.replace('<|', '< |')}{CLOSE}" for r, t, _ in turns)


FIELDS = "n_turns long, n_out long, cost long, n_merged long, n_relabeled long, n_inserted long, was_legal boolean, roles string, rendered string"


def repair_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: what was repaired and the rendered text; a turn without conv_id is a conversation of its own."""
    one = turns.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("t"), F.col(role).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("x")).alias("s"))
    convs = one.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("s"))
    convs = convs.unionByName(one.filter("conv_id is null").select("conv_id", F.array("s").alias("s")))
    names = ["conv_id", *(x.split()[0] for x in FIELDS.split(", "))]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for conv in b.column(1).to_pylist():
                given = [(x["r"], x["x"]) for x in conv]
                cost, out = repair(given)
                how = [h for _, _, h in out]
                n_relabel = n_merge = 0
                n_merge = len(given) + how.count("insert") - len(out)
                n_relabel = how.count("relabel")
                rows.append((len(given), len(out), cost, n_merge, n_relabel, how.count("insert"), legal([r for r, _ in given]), ",".join(r for r, _, _ in out), render(out)))
            kinds = [*[pa.int64()] * 6, pa.bool_(), pa.string(), pa.string()]
            yield pa.record_batch([b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names)

    return convs.mapInArrow(run, f"conv_id {dict(turns.dtypes)[conv_id]}, {FIELDS}")


def op4_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repair_conversations(table(spark, sf_dir, "conversations"))
    return out.select(*[c for c in out.columns if c != "rendered"], F.sha2("rendered", 256).alias("rendered_sha256"), F.length("rendered").cast("long").alias("n_chars"))


