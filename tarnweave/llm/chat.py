"""Chat formatting: conversations merged in prefix trees, shared turns emitted once depth-first."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.llm.hot import join_by_weight
from tarnweave.session import stash

_OPEN, _MIDDLE, _CLOSE = "<|turn:", "|>", "<|end|>\n"
_TURN = re.compile(r"<\|turn:((?:[^|\\]|\\.)*)\|>((?:[^|\\]|\\.)*)<\|end\|>\n", re.S)


@dataclass(frozen=True)
class ChatParams:
    """``crowd``, ``size``: distinct conversations that share turns, and code points of all their
    turns, up to which they are one tree; beyond, the shared turns are a stem that several trees
    stand on. ``learned``: the role under the loss mask."""

    crowd: int = 128
    size: int = 4 << 20
    learned: str = "assistant"


def escape(text: str) -> str:
    """Every ``|`` and backslash gets a backslash, so no text holds a mark: they all need ``|``."""
    return text.replace("\\", "\\\\").replace("|", "\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turn(role: str, text: str) -> str:
    return f"{_OPEN}{escape(role)}{_MIDDLE}{escape(text)}{_CLOSE}"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start to end is its escaped text."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)))
        at = m.end()
    return out


def code_points(text: str) -> list[int]:
    return list(map(ord, text))


class Tree:
    """Conversations by shared initial turns. A segment is a turn that is emitted once.

    ``before``: names of the stems that the tree stands on, from the root; ``stem``: their turns."""

    def __init__(self, name: str = "", before: Sequence[str] = (), stem: Sequence[tuple[str, str]] = ()):
        self.name, self.before, self.stem = name, list(before), list(stem)
        self.children: list[dict[tuple[str, str], int]] = [{}]
        self.turns: list[tuple[str, str]] = [("", "")]
        self.ends: list[list] = [[]]

    def add(self, turns: list[tuple[str, str]], key) -> None:
        node = 0
        for turn in turns:
            following = self.children[node].get(turn)
            if following is None:
                following = self.children[node][turn] = len(self.turns)
                self.children.append({})
                self.turns.append(turn)
                self.ends.append([])
            node = following
        self.ends[node].append(key)

    def emit(self, encode: Callable[[str], list[int]], learned: str) -> dict:
        """Tokens depth-first, each with its position in its conversations and its loss mask; the
        segments with the intervals of the tree's tokens that they attend to: their ancestors and
        their own start, after all tokens of the stems; and the segment that each conversation ends
        with (-1: the last stem, or no turns)."""
        tokens: list[int] = []
        positions: list[int] = []
        mask: list[bool] = []
        segments: list[dict] = []
        leaves: list[dict] = [{"key": k, "segment": -1} for k in self.ends[0]]
        base = sum(len(encode(part)) for turn in self.stem for part, _ in _parts(*turn, learned))
        todo = [(node, -1, base) for node in reversed(self.children[0].values())]
        while todo:
            node, parent, depth = todo.pop()
            ids: list[int] = []
            for part, learn in _parts(*self.turns[node], learned):
                encoded = encode(part)
                ids += encoded
                mask += [learn] * len(encoded)
            start = len(tokens)
            tokens += ids
            positions += range(depth, depth + len(ids))
            before = [] if parent < 0 else [*segments[parent]["attends"]]
            if before and before[-1]["stop"] == start:
                before[-1] = {"start": before[-1]["start"], "stop": len(tokens)}
            else:
                before.append({"start": start, "stop": len(tokens)})
            segments.append({"start": start, "stop": len(tokens), "parent": parent, "attends": before})
            here = len(segments) - 1
            leaves += ({"key": k, "segment": here} for k in self.ends[node])
            todo += ((c, here, depth + len(ids)) for c in reversed(self.children[node].values()))
        return {
            "tree_id": self.name, "before": self.before, "tokens": tokens, "positions": positions, "loss_mask": mask,
            "segments": segments, "leaves": leaves,
        }


def _parts(role: str, text: str, learned: str) -> tuple[tuple[str, bool], ...]:
    """What a turn is written as, part by part, and whether the part is learned."""
    return (f"{_OPEN}{escape(role)}{_MIDDLE}", False), (escape(text), role == learned), (_CLOSE, False)


_INTERVAL = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
_SEGMENT = pa.struct(
    [("start", pa.int32()), ("stop", pa.int32()), ("parent", pa.int32()), ("attends", pa.list_(_INTERVAL))]
)
_TREE = pa.schema(
    [("tree_id", pa.string()), ("before", pa.list_(pa.string()))]
    + [("tokens", pa.list_(pa.int32())), ("positions", pa.list_(pa.int32()))]
    + [("loss_mask", pa.list_(pa.bool_())), ("segments", pa.list_(_SEGMENT))]
    + [("leaves", pa.list_(pa.struct([("key", pa.string()), ("segment", pa.int32())])))]
)
_TREE_SQL = (
    "tree_id string, before array<string>, tokens array<int>, positions array<int>, loss_mask array<boolean>, "
    "segments array<struct<start:int,stop:int,parent:int,attends:array<struct<start:int,stop:int>>>>, "
    "leaves array<struct<key:string,segment:int>>"
)


def assembled(rows: DataFrame) -> DataFrame:
    """(conv_id, n, key, turns): each conversation's turns in order, and a digest of what they say.

    Turns come in order of turn (null first), then role, then text. Null roles and texts are
    empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct(F.col("turn"), text("role").alias("role"), text("text").alias("text"))
    said = F.transform(F.array_sort(F.collect_list(turn)), lambda t: F.struct(t["role"], t["text"]))
    grouped = rows.groupBy("conv_id").agg(said.cast("array<struct<role:string,text:string>>").alias("turns"))
    return grouped.withColumn("key", F.sha2(F.to_json("turns"), 256))


def _led(distinct: DataFrame) -> DataFrame:
    """(key, turns, nodes, size): with a name for each initial run of a conversation's turns, and
    its code points."""
    def run(batches):
        for batch in batches:
            nodes, sizes = [], []
            for turns in batch["turns"].to_pylist():
                name, names, size = b"", [], 0
                for t in turns:
                    said = f"{len(t['role'])}:{t['role']}{t['text']}"
                    size += len(said)
                    name = xxhash.xxh3_128_digest(name + said.encode("utf-8", "surrogatepass"))
                    names.append(name.hex())
                nodes.append(names)
                sizes.append(size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nodes, pa.list_(pa.string())), pa.array(sizes, pa.int64())],
                ["key", "turns", "nodes", "size"],
            )

    return distinct.mapInArrow(run, "key string, turns array<struct<role:string,text:string>>, nodes array<string>, size long")


def _stems(led: DataFrame, p: ChatParams) -> DataFrame:
    """(node, n, parts, at, key): initial runs that too many conversations share for one tree, how
    many do, in how many trees they go on, the last turn's place, and one of the conversations."""
    shared = led.select("key", "size", F.posexplode("nodes").alias("at", "node")).groupBy("node").agg(
        F.count("*").alias("n"), F.sum("size").alias("size"), F.first("at").alias("at"), F.min("key").alias("key")
    )
    parts = F.ceil(F.greatest(F.col("n") / p.crowd, F.col("size") / p.size)).cast("int")
    return shared.where((F.col("n") > 1) & (parts > 1)).select("node", "n", parts.alias("parts"), "at", "key")


def trees(
    conversations: DataFrame, params: ChatParams | None = None, encode: Callable[[str], list[int]] = code_points
) -> DataFrame:
    """One row per prefix tree over the distinct conversations of ``assembled``: tree_id, the stems
    that come before it, tokens, positions, loss mask, segments with ancestor intervals, and the
    segment that each conversation ends with.

    Equal conversations are merged before trees are dealt out. Those that share a first turn form
    one tree. Turns that more than ``crowd`` conversations share, or larger ones than ``size``
    together, are stems: rows of one turn, which come before trees by name, so that no turn is
    emitted twice however many share it. What follows on a stem is dealt out by its next turn."""
    p = params or ChatParams()
    led = stash(_led(conversations.groupBy("key").agg(F.first("turns").alias("turns"))))
    stems = stash(_stems(led, p))
    steps = led.select("key", F.posexplode("nodes").alias("depth", "node"))
    top = join_by_weight(steps, stems.select("node", "n", "parts"), "node", "n").groupBy("key").agg(
        F.max(F.struct("depth", "node", "parts")).alias("top")
    )
    depth = F.coalesce(F.col("top.depth") + 1, F.lit(0))
    following = F.pmod(F.xxhash64(F.get("nodes", depth)), F.col("top.parts"))
    name = F.when(F.col("top").isNotNull(), F.concat_ws("/", "top.node", following)).otherwise(
        F.coalesce(F.get("nodes", F.lit(0)), F.lit("none"))
    )
    dealt = led.join(top, "key", "left").select(name.alias("tree_id"), "key", depth.alias("depth"), "turns", "nodes")
    of_stems = stems.select("node", "at", "key").join(led, "key").select(
        F.col("node").alias("tree_id"), F.lit(None).cast("string").alias("key"), F.col("at").alias("depth"),
        F.slice("turns", F.lit(1), F.col("at") + 1).alias("turns"), "nodes",
    )
    rows = dealt.unionByName(of_stems).withColumn("before", F.slice("nodes", F.lit(1), F.col("depth"))).drop("nodes")

    def run(batches):
        tree = None
        for batch in batches:
            for row in batch.to_pylist():
                turns = [(t["role"], t["text"]) for t in row["turns"]]
                if tree is None or tree.name != row["tree_id"]:
                    if tree:
                        yield pa.RecordBatch.from_pylist([tree.emit(encode, p.learned)], _TREE)
                    tree = Tree(row["tree_id"], row["before"], turns[: row["depth"]])
                tree.add(turns[row["depth"] :], row["key"])
        if tree:
            yield pa.RecordBatch.from_pylist([tree.emit(encode, p.learned)], _TREE)

    return rows.repartition("tree_id").sortWithinPartitions("tree_id", "key").mapInArrow(run, _TREE_SQL)


def _with_stems(forest: DataFrame) -> DataFrame:
    """``forest`` with stem_tokens and stem_mask: what comes before each tree."""
    standing = forest.where(F.size("before") > 0)
    names = standing.select(F.col("tree_id").alias("on"), F.posexplode("before").alias("no", "tree_id"))
    uses = names.groupBy("tree_id").agg(F.count("*").alias("n"))
    stems = forest.select("tree_id", "tokens", "loss_mask").join(uses, "tree_id")
    of_tree = join_by_weight(names, stash(stems), "tree_id", "n").groupBy(F.col("on").alias("tree_id")).agg(
        F.array_sort(F.collect_list(F.struct("no", "tokens", "loss_mask"))).alias("s")
    )
    joined = standing.join(
        of_tree.select("tree_id", F.flatten("s.tokens").alias("stem_tokens"), F.flatten("s.loss_mask").alias("stem_mask")), "tree_id"
    )
    none = lambda kind: F.array().cast(f"array<{kind}>")
    alone = forest.where(F.size("before") == 0).withColumns({"stem_tokens": none("int"), "stem_mask": none("boolean")})
    return joined.unionByName(alone)


def read_back(forest: DataFrame, decode: Callable[[list[int]], str] = lambda ids: "".join(map(chr, ids))) -> DataFrame:
    """Per distinct conversation: key, n_turns, turns_sha256, loss_chars, loss_sha256 and
    formatted_chars, from the tokens of its tree's stems, those that its last segment attends to,
    and their loss mask."""
    schema = pa.schema(
        [("key", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64())]
        + [("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def row(tree, leaf) -> dict:
        intervals = tree["segments"][leaf["segment"]]["attends"] if leaf["segment"] >= 0 else []
        of = lambda name: [x for i in intervals for x in tree[name][i["start"] : i["stop"]]]
        ids, mask = tree["stem_tokens"] + of("tokens"), tree["stem_mask"] + of("loss_mask")
        text = decode(ids)
        turns = parse(text)
        learned = unescape(decode([t for t, m in zip(ids, mask, strict=True) if m]))
        said = "".join(f"{role}\n{body}\n" for role, body, _, _ in turns)
        digest = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        return {
            "key": leaf["key"], "n_turns": len(turns), "turns_sha256": digest(said), "loss_chars": len(learned),
            "loss_sha256": digest(learned), "formatted_chars": len(text),
        }

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                tree = batch.slice(k, 1).to_pylist()[0]
                yield pa.RecordBatch.from_pylist([row(tree, leaf) for leaf in tree["leaves"] if leaf["key"] is not None], schema)

    return _with_stems(forest).select("stem_tokens", "stem_mask", "tokens", "loss_mask", "segments", "leaves").mapInArrow(
        run,
        "key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def formatted(
    rows: DataFrame, params: ChatParams | None = None, id_col: str = "conv_id"
) -> DataFrame:
    """conv_id (under the name of ``id_col``), n_turns, turns_sha256, loss_chars, loss_sha256 and
    formatted_chars of every conversation, read back from the trees.

    Rows of a null id are one conversation. Repeated rows are turns of their own. Other columns are
    ignored; an empty table gives an empty result."""
    rows = rows.select(
        F.col(id_col).alias("conv_id"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    conversations = stash(assembled(rows))
    said = read_back(stash(trees(conversations, params)))
    out = conversations.select("conv_id", "key").join(said, "key").drop("key")
    return out.withColumnRenamed("conv_id", id_col)
