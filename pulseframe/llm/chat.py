"""Chat formatting in budgeted windows with a loss mask.

Turns of a conversation are ordered by (turn, role, text); nulls come first and repeated rows stay. Prefix sums of turn
tokens choose turn-aligned spans: with room B for new turns, the turns that lie between two multiples of B form one span,
and a turn that crosses a multiple is a span of its own. So a span holds at most B tokens unless a single turn is larger,
which is kept whole. Every window repeats the leading system turn and up to ``history_turns`` turns before its span, at
most ``history_tokens`` tokens of them; repeated turns are never targets, so each assistant text is a target once.

Prefix sums come from range partitions and history from joins on (conversation, position): no conversation, however
long, is ordered or gathered in one task; only the turns of one window are put together.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts each ``<``, run of backslashes, ``|`` gets one more
backslash, which takes control strings out of texts and is undone exactly. In roles, backslashes and line feeds are
escaped too. A null role or text is empty. An empty table gives no window. Other columns are not used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.scale import running_totals
from pulseframe.llm.common import stored

START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class ChatParams:
    budget: int = 1024
    history_turns: int = 2
    history_tokens: int = 256
    target_role: str = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def token_count(text: Column) -> Column:
    """Words and single other characters, the size of a turn before any vocabulary is chosen, and three for the marks."""
    return (F.regexp_count(text, F.lit(r"\w+|[^\w\s]")) + 3).cast("long")


def chat_windows(df: DataFrame, params: ChatParams = ChatParams()) -> DataFrame:
    """conv_id, window (number in the conversation), text, n_repeated (leading turns already seen), tokens, targets.

    ``targets`` are [begin, end) code-point spans of the text that the loss covers, in order.
    """
    turns = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = turns.withColumn("tokens", token_count("text"))
    order = ["turn", "role", "text"]
    # Equal rows share one position run, so sums and positions are per distinct row and spread again after.
    distinct = turns.groupBy("conv_id", *order).agg(F.count(F.lit(1)).alias("copies"), F.max("tokens").alias("tokens"))
    distinct = distinct.withColumn("all_tokens", F.col("tokens") * F.col("copies"))
    placed = running_totals(distinct, ["conv_id"], order, ["copies", "all_tokens"])
    rows = placed.select("conv_id", "role", "text", "tokens", "before_copies", "before_all_tokens",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    rows = rows.select("conv_id", (F.col("before_copies") + F.col("copy")).alias("pos"), "role", "text", "tokens",
                       (F.col("before_all_tokens") + F.col("copy") * F.col("tokens")).alias("start"))
    rows = stored(rows, "chat-turns")
    leading = rows.filter((F.col("pos") == 0) & (F.col("role") == "system")).select(
        "conv_id", F.col("role").alias("system_role"), F.col("text").alias("system_text"), F.col("tokens").alias("system_tokens"))
    left, right = rows.alias("r"), leading.alias("s")
    rows = left.join(right, F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")), "left").select("r.*", "system_tokens")

    room = F.greatest(F.lit(1), F.lit(params.budget - params.history_tokens) - F.coalesce("system_tokens", F.lit(0)))
    new = F.col("pos") - F.when(F.col("system_tokens").isNotNull(), 1).otherwise(0)
    rows = rows.filter((new >= 0) | (F.col("system_tokens").isNull())).withColumn(
        "start", F.col("start") - F.coalesce("system_tokens", F.lit(0)))
    first_bin, last_bin = F.floor(F.col("start") / room), F.floor((F.col("start") + F.col("tokens") - 1) / room)
    # A span is named by the first position in its bin, or by the turn's own when it crosses a border.
    spans = rows.withColumns({"bin": first_bin, "crosses": first_bin != last_bin})
    heads = spans.filter(~F.col("crosses")).groupBy("conv_id", "bin").agg(F.min("pos").alias("head"))
    a, b = spans.alias("a"), heads.alias("b")
    spans = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.bin") == F.col("b.bin")) & ~F.col("a.crosses"), "left")
    spans = stored(spans.select("a.*", F.coalesce("b.head", "a.pos").alias("head")).drop("bin", "crosses"), "chat-spans")

    # History: the turns just before each head, looked up by position.
    heads = spans.filter(F.col("pos") == F.col("head")).select("conv_id", "head", F.col("start").alias("head_start"))
    wanted = heads.filter(F.col("head") > 0).select(
        "*", F.explode(F.sequence(F.greatest(F.lit(0), F.col("head") - params.history_turns), F.col("head") - 1)).alias("pos")
    ) if params.history_turns > 0 else heads.withColumn("pos", F.col("head")).limit(0)
    w, s = wanted.alias("w"), spans.alias("s")
    history = w.join(s, F.col("w.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("w.pos") == F.col("s.pos"))).filter(
        F.col("w.head_start") - F.col("s.start") <= params.history_tokens).select(
        "w.conv_id", "w.head", "s.pos", "s.role", "s.text", "s.tokens", F.lit(1).alias("kind"))
    own = spans.select("conv_id", "head", "pos", "role", "text", "tokens", F.lit(2).alias("kind"))
    every, lead = heads.alias("h"), leading.alias("s")
    # Every window gets the system turn; the first one introduces it.
    first_head = heads.groupBy("conv_id").agg(F.min("head").alias("first"))
    system = every.join(lead, F.col("h.conv_id").eqNullSafe(F.col("s.conv_id"))).join(
        first_head.alias("f"), F.col("h.conv_id").eqNullSafe(F.col("f.conv_id"))).select(
        "h.conv_id", "h.head", F.lit(0).cast("long").alias("pos"), F.col("s.system_role").alias("role"),
        F.col("s.system_text").alias("text"), F.col("s.system_tokens").alias("tokens"),
        F.when(F.col("h.head") == F.col("f.first"), 2).otherwise(0).alias("kind"))
    # A conversation of a system turn alone.
    c, h = leading.alias("c"), first_head.alias("h")
    alone = c.join(h, F.col("c.conv_id").eqNullSafe(F.col("h.conv_id")), "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("head"), F.lit(0).cast("long").alias("pos"), F.col("system_role").alias("role"),
        F.col("system_text").alias("text"), F.col("system_tokens").alias("tokens"), F.lit(2).alias("kind"))
    parts = own.unionByName(history).unionByName(system).unionByName(alone)

    front = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    is_target = (F.col("kind") == 2) & (F.col("role") == params.target_role)
    part = F.struct(
        "pos", F.col("kind").alias("kind"), F.concat(front, body, F.lit(END + "\n")).alias("piece"), F.col("tokens").alias("tokens"),
        F.when(is_target, F.char_length(front)).otherwise(-1).alias("begin"), F.char_length(body).alias("length"))
    windows = parts.groupBy("conv_id", "head").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))
    masked = F.aggregate("parts", zero, lambda acc, p: F.struct(
        (acc["at"] + F.char_length(p["piece"])).alias("at"),
        F.when(p["begin"] >= 0, F.array_append(acc["spans"], F.struct(
            (acc["at"] + p["begin"]).alias("begin"), (acc["at"] + p["begin"] + p["length"]).alias("end"))))
        .otherwise(acc["spans"]).alias("spans")))
    return windows.select(
        "conv_id", F.col("head").alias("window"), F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("text"),
        F.size(F.filter("parts", lambda p: p["kind"] < 2)).alias("n_repeated"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda t, p: t + p["tokens"]).alias("tokens"), masked["spans"].alias("targets"))


_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation: digests of its turns and of its targets, read from the formatted windows alone.

    Windows are sorted by number inside hash partitions and hashed as they pass, so memory holds one window at a time.
    """
    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict = {}

        def result() -> pd.DataFrame:
            return pd.DataFrame([[state["id"], state["turns"], state["all"].hexdigest(), state["chars"],
                                  state["loss"].hexdigest(), state["size"]]], columns=names)

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            done = []
            for conv, text, repeated, targets in zip(batch["conv_id"], batch["text"], batch["n_repeated"], batch["targets"]):
                conv = None if pd.isna(conv) else int(conv)
                if not state or state["id"] != conv:
                    if state:
                        done.append(result())
                    state = {"id": conv, "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0}
                turns = parse(text)
                # The new turns of a window are its last ones; the first window's system turn is new as well.
                for role, said in turns[repeated:]:
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in targets:
                    said = unescape(text[span["begin"] : span["end"]])
                    state["chars"] += len(said)
                    state["loss"].update(said.encode("utf-8", "surrogatepass"))
                state["size"] += len(text)
            if done:
                yield pd.concat(done).astype({"conv_id": "Int64"})
        if state:
            yield result().astype({"conv_id": "Int64"})

    ordered = windows.select("conv_id", "window", "text", "n_repeated", "targets").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInPandas(digested, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
