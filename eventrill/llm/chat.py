"""Chat formatting of reply trees. DataFrame functions only.

Messages point to the message they answer. Pointer doubling by self-joins gives every
message its depth and the summed score of its path from the root in as many joins as the
depth has binary digits; a conversation whose paths are all known takes no part in further
joins. Leaves are ranked by that score, and only the chosen leaves' paths are enumerated,
again by doubling. Each chosen path becomes one formatted conversation with
a mask of what to learn from.

Template: ``<|im_start|>`` role newline text ``<|im_end|>`` newline, per turn. In roles and
texts ``&`` becomes ``&a``, ``<`` ``&l`` and ``[`` ``&b`` (in roles a line end ``&n``), so
that no control string of this or another template (``</s>``, ``[INST]``) is left, and every
text can be read back. The loss mask is a list of byte ranges of the formatted UTF-8 text.

Defined results: a null role or text is empty; messages that share a turn are ordered by
role, then text; a message whose parent does not exist, and a repeated message id's later
row, are roots of their own; messages on a cycle have no root and are in no conversation; a
null conversation id is an id like others; an empty table gives no conversations; other
columns are not read. One formatted conversation is one row, so one path has to fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventrill.llm.common import shared_table
from eventrill.session import broadcast_if_small, written

# The marks of the template, and what stands for signs that could begin a mark.
START, END = "<|im_start|>", "<|im_end|>\n"
ESCAPES = (("&", "&a"), ("<", "&l"), ("[", "&b"))
LEARNED_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    for sign, code in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for sign, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&n"), F.lit("\n")))


def reply_chain(turns: DataFrame) -> DataFrame:
    """Linear conversations ``conv_id, turn, role, text`` as reply trees of one branch.

    ``msg_id`` counts a conversation's turns from 1; ``score`` is 1 each.
    """
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).cast("bigint").alias("msg_id"))
    parent = F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)
    return numbered.select("conv_id", "msg_id", parent.alias("parent_id"), "role", "text", F.lit(1.0).alias("score"))


def _same(left: str, right: str, a: str, b: str) -> Column:
    return F.col(f"{left}.conv_id").eqNullSafe(F.col(f"{right}.conv_id")) & (F.col(f"{left}.{a}") == F.col(f"{right}.{b}"))


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``conv_id, branch, at, msg_id``: the ``branches`` best root-to-leaf paths of each conversation.

    A path's rank is its summed score, then its length, then the smaller leaf id; ``at``
    counts from the root.
    """
    nodes = messages.select("conv_id", "msg_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select("conv_id", "msg_id")
    parents = nodes.alias("n").join(known.alias("p"), _same("n", "p", "parent_id", "msg_id"), "left")
    # up: the ancestor 2^k above, or null if the root is nearer; then depth and total are complete
    step = parents.select(
        "n.conv_id", "n.msg_id", F.col("p.msg_id").alias("up"), F.lit(1).cast("bigint").alias("depth"),
        F.col("n.score").alias("total"),
    )
    state, jumps, known_paths = shared_table(step, "chat"), [], []
    while not (waiting := state.where(F.col("up").isNotNull())).isEmpty():
        # conversations without a longer path have been read to the end
        live = broadcast_if_small(written(waiting.select("conv_id").distinct(), "chat"))
        in_live = F.col("s.conv_id").eqNullSafe(F.col("l.conv_id"))
        known_paths.append(state.alias("s").join(live.alias("l"), in_live, "left_anti"))
        jumps.append(shared_table(state.alias("s").join(live.alias("l"), in_live, "left_semi"), "chat"))
        # after k rounds a path without a cycle is known if it has up to 2^k messages
        if _all_on_cycles(jumps[-1], len(jumps)):
            state = jumps[-1]
            break
        ahead = jumps[-1].select("conv_id", "msg_id", F.col("up").alias("far"), "depth", "total")
        joined = jumps[-1].alias("n").join(ahead.alias("a"), _same("n", "a", "up", "msg_id"), "left").select(
            "n.conv_id", "n.msg_id", F.col("a.far").alias("up"),
            (F.col("n.depth") + F.coalesce("a.depth", F.lit(0))).alias("depth"),
            (F.col("n.total") + F.coalesce("a.total", F.lit(0.0))).alias("total"),
        )
        state = shared_table(joined, "chat")
    whole = state.where(F.col("up").isNull())
    for known in known_paths:
        whole = whole.unionByName(known)
    inner = messages.select("conv_id", F.col("parent_id").alias("msg_id")).where("msg_id IS NOT NULL")
    leaves = whole.alias("n").join(inner.alias("i"), _same("n", "i", "msg_id", "msg_id"), "left_anti")
    best = Window.partitionBy("conv_id").orderBy(F.desc("total"), F.desc("depth"), "msg_id")
    chosen = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= branches)
    # every ancestor is reached by exactly one sum of powers of two: largest jumps first
    reached = chosen.select("conv_id", "branch", F.col("depth").alias("at"), "msg_id")
    for k in reversed(range(len(jumps))):
        jump = jumps[k].where(F.col("up").isNotNull())
        further = reached.alias("r").join(jump.alias("j"), _same("r", "j", "msg_id", "msg_id")).select(
            "r.conv_id", "r.branch", (F.col("r.at") - 2**k).alias("at"), F.col("j.up").alias("msg_id")
        )
        reached = shared_table(reached.unionByName(further), "chat")
    return reached


def _all_on_cycles(jump: DataFrame, rounds: int) -> bool:
    """Whether every message that still has a far ancestor is on a cycle or below one."""
    return rounds >= 8 and 2 ** (rounds - 1) > jump.count()


def formatted(messages: DataFrame, branches: int = 1, learned: tuple[str, ...] = LEARNED_ROLES) -> DataFrame:
    """``conv_id, branch, n_turns, formatted, loss_spans``; a span is ``start, end`` in UTF-8 bytes."""
    one = messages.groupBy("conv_id", "msg_id").agg(
        F.min(F.struct(F.col("parent_id").isNull().alias("root"), "parent_id", "role", "text", "score")).alias("m")
    )
    one = shared_table(one.select("conv_id", "msg_id", "m.parent_id", "m.role", "m.text", "m.score"), "chat")
    chosen = paths(one, branches)
    rows = chosen.alias("r").join(one.alias("m"), _same("r", "m", "msg_id", "msg_id"))
    role, text = F.coalesce("m.role", F.lit("")), F.coalesce("m.text", F.lit(""))
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    turn = F.struct(
        F.col("r.at").alias("at"), head.alias("head"), escape(text).alias("body"), role.isin(*learned).alias("learned")
    )
    by = rows.groupBy("r.conv_id", "r.branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    parts = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(acc, t):
        start = acc["at"] + F.octet_length(t["head"])
        end = start + F.octet_length(t["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + F.octet_length(F.lit(END))).cast("bigint").alias("at"),
            F.when(t["learned"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return by.select(
        "conv_id", "branch", F.size("turns").cast("bigint").alias("n_turns"), F.array_join(parts, "").alias("formatted"),
        F.aggregate("turns", zero, add, lambda acc: acc["spans"]).alias("loss_spans"),
    )


_SPANS = "array<struct<start: bigint, end: bigint>>"


def read_back(out: DataFrame) -> DataFrame:
    """``turns`` (role and text, unescaped) and ``learned`` (the texts under the mask) of formatted rows."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != "")
    inner = F.transform(pieces, lambda p: F.substr(p, F.lit(len(START) + 1)))

    def turn(p):
        role = F.substring_index(p, "\n", 1)
        text = F.substr(p, F.length(role) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    raw = F.encode("formatted", "UTF-8")
    masked = F.transform(
        "loss_spans",
        lambda s: unescape(F.decode(F.substr(raw, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), "UTF-8")),
    )
    return out.withColumn("turns", F.transform(inner, turn)).withColumn("learned", masked)
