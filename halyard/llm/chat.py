r"""Operator 9, chat formatting by schema fingerprints.

A record's layout is the set of its nested field paths; the hash of that set selects a
declarative mapping, and the mapping turns the record into canonical turns. Turns are
written with a template whose control strings, should a text hold one, are escaped
reversibly, so that a reader gets back every turn and every character under the loss
mask.

Template, for each turn::

    <|turn|>role<|text|>text<|end|>\n

Escape: a backslash after the first character of each control string in a text; where
backslashes stand there already, one more. Taking one away undoes it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Control strings: the template's own and those of common chat templates.
CONTROLS = ("<|turn|>", "<|text|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ANY = re.compile("|".join(rf"{re.escape(c[0])}(\\*){re.escape(c[1:])}" for c in CONTROLS))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\(\\*){re.escape(c[1:])}" for c in CONTROLS))
_HEAD = re.compile(rf"{re.escape(TURN)}(.*?){re.escape(TEXT)}", re.S)

#: Roles under other names, in layouts that use them.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LEARNED = "assistant"


def escape(text: str) -> str:
    return _ANY.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def paths(record, at: str = "") -> set[str]:
    """Paths of all fields that hold a value; ``[]`` stands for any element of a list.
    A field that is null, or an empty list, counts as absent."""
    if isinstance(record, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in record.items()))
    if isinstance(record, list):
        return set().union(*(paths(v, f"{at}[]") for v in record))
    return set() if record is None else {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


def _chat(items: str, role: str, text: str, roles: dict[str, str] | None = None) -> dict:
    return {"paths": [f"{items}[].{role}", f"{items}[].{text}"], "optional": [f"{items}[].turn"], "items": items, "role": role, "text": text, "roles": roles or {}}


def _fields(*turns: tuple[str, str], optional: tuple[str, ...] = (), joined: tuple[str, ...] = ()) -> dict:
    """turns: (role, field), in order; joined: fields that follow the user's text after a blank line."""
    return {"paths": [f for _, f in turns if f not in optional], "optional": [*optional, *joined], "turns": turns, "joined": joined}


#: Layouts as declarations. Optional paths may be absent: each subset has its own fingerprint.
LAYOUTS = (
    _chat("messages", "role", "content"),
    _chat("messages", "role", "text"),
    _chat("conversations", "from", "value", ROLES),
    _chat("turns", "speaker", "text", ROLES),
    _fields(("system", "system"), ("user", "prompt"), ("assistant", "completion"), optional=("system",)),
    _fields(("system", "system"), ("user", "prompt"), ("assistant", "response"), optional=("system",)),
    _fields(("system", "system"), ("user", "question"), ("assistant", "answer"), optional=("system",)),
    _fields(("system", "system_prompt"), ("user", "question"), ("assistant", "response"), optional=("system_prompt",)),
    _fields(("system", "system"), ("user", "instruction"), ("assistant", "output"), optional=("system",), joined=("input",)),
)


def registry(layouts=LAYOUTS) -> dict[str, dict]:
    """Fingerprint to mapping; two layouts that claim one fingerprint are an error."""
    found: dict[str, dict] = {}
    for m in layouts:
        for bits in range(1 << len(m["optional"])):
            key = fingerprint({*m["paths"], *(p for i, p in enumerate(m["optional"]) if bits >> i & 1)})
            if key in found:
                raise ValueError(f"two layouts have the same paths: {m['paths']}")
            found[key] = m
    return found


_REGISTRY = registry()


def turns_of(record: dict, mapping: dict) -> list[tuple[str, str]]:
    """Canonical turns (role, text); a missing role is empty, a missing text too."""
    if "items" in mapping:
        items = [x for x in record[mapping["items"]] if x is not None]
        if any(x.get("turn") is not None for x in items):
            items.sort(key=lambda x: (x.get("turn") is None, x.get("turn") or 0))
        return [(mapping["roles"].get(r := str(x.get(mapping["role"]) or ""), r), str(x.get(mapping["text"]) or "")) for x in items]
    out = []
    for role, field in mapping["turns"]:
        if record.get(field) is not None:
            text = str(record[field])
            if role == "user":
                text = "\n\n".join([text, *(str(record[f]) for f in mapping["joined"] if record.get(f))])
            out.append((role, text))
    return out


def write(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """(formatted text, loss mask as flat pairs of start and end). The mask covers what an assistant says."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == LEARNED:
            spans += [at + len(head), at + len(head) + len(body)]
        at += len(head) + len(body) + len(END)
        parts += [head, body, END]
    return "".join(parts), spans


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        end = formatted.index(END, head.end())
        turns.append((unescape(head[1]), unescape(formatted[head.end() : end])))
        at = end + len(END)
    return turns


def _record(raw: str | None):
    try:
        value = json.loads(raw) if raw else None
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def format_chats(records: DataFrame, id_col: str = "conv_id", json_col: str = "record") -> DataFrame:
    """(id, layout, n_turns, formatted, loss_spans) of each JSON record, row by row.

    No JSON object, or a layout that no mapping declares: ``layout`` holds the
    fingerprint (null if it isn't an object) and the rest is null; no row is lost.
    Repeated rows are formatted each; other columns are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, raw in zip(pdf["id"], pdf["record"], strict=True):
                record = _record(raw)
                layout = None if record is None else fingerprint(paths(record))
                if (mapping := _REGISTRY.get(layout)) is None:
                    out.append((key, layout, None, None, None))
                else:
                    turns = turns_of(record, mapping)
                    text, spans = write(turns)
                    out.append((key, layout, len(turns), text, spans))
            yield pd.DataFrame(out, columns=["id", "layout", "n_turns", "formatted", "loss_spans"]).astype({"id": "Int64", "n_turns": "Int64"})

    rows = records.select(F.col(id_col).cast("long").alias("id"), F.col(json_col).cast("string").alias("record"))
    return rows.mapInPandas(run, "id long, layout string, n_turns long, formatted string, loss_spans array<long>").withColumnRenamed("id", id_col)


def digest(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the formatted texts say, read back from them alone (and their masks)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, text, spans in zip(pdf["id"], pdf["formatted"], pdf["loss_spans"], strict=True):
                if text is None:
                    out.append((key, None, None, None, None, None))
                    continue
                turns = read(text)
                said = hashlib.sha256()
                for role, body in turns:
                    said.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                spans = [int(x) for x in spans]
                loss = "".join(unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True))
                out.append((key, len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
            columns = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pd.DataFrame(out, columns=columns).astype({c: "Int64" for c in ("id", "n_turns", "loss_chars", "formatted_chars")})

    rows = formatted.select(F.col(id_col).alias("id"), "formatted", "loss_spans")
    return rows.mapInPandas(run, "id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumnRenamed("id", id_col)


def conversation_records(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): rows by turn become one JSON record of the ``messages`` layout.

    Order: turn (null last), then role and text, so repeated turns have a defined place.
    Null role or text: empty. Null conv_id: a conversation of its own. A conversation's
    turns meet in one row: it is one text in the end.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    grouped = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    messages = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    return grouped.select("conv_id", F.to_json(F.struct(messages.alias("messages"))).alias("record"))


def chat_query(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    return digest(format_chats(conversation_records(rows.unionByName(extra))))
