"""The model tier: requests out, answers in, through a pluggable resolver.

A resolver answers prompts; it is created once per task (``factory()``) and used in
``mapInPandas``. Windows without anything to resolve are filtered before that call, since
Catalyst cannot see into it. ``RuleResolver`` is deterministic and needs no network.
"""

from __future__ import annotations

import json
import re
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import windows as Wn

ATTRIBUTIONS = "attributions array<struct<index:int,speaker:string>>"
CRITIQUE = "corrections array<struct<index:int,speaker:string,reason:string>>, roster_issues array<struct<name:string,verdict:string,canonical:string,reason:string>>, overall_quality double"
CHARACTERS = "characters array<struct<name:string,aliases:array<string>,pronunciation_hints:array<string>>>"
CHAPTERS = "chapters array<struct<title:string,start_line:string>>"
#: Kinds of objection to a roster entry.
VERDICTS = ["not_a_character", "duplicate", "ok"]


class ResolverError(Exception):
    """A request that got no usable answer."""


class Resolver(Protocol):
    def resolve(self, system: str, user: str, schema: dict | None) -> str: ...


def base_url(url: str) -> str:
    """A server's address, with ``/v1`` where it has no path."""
    url = url.rstrip("/")
    return url if urlparse(url).path.strip("/") else url + "/v1"


def picked_model(offered: list[str], wanted: str | None) -> str:
    """The model to use: the first one offered if none is wanted, else the first where one of both names begins with the other."""
    fits = [m for m in offered if not wanted or m.startswith(wanted) or wanted.startswith(m)]
    exact = [m for m in fits if m == wanted]
    if not fits:
        raise ResolverError(f"{wanted or 'a model'} is not among {offered}")
    return (exact or fits)[0]


def parsed_answer(content: str) -> dict:
    """The JSON object of an answer, with or without fences."""
    body = re.sub(r"\n?```$", "", re.sub(r"^```[^\n]*\n", "", content.strip())).strip()
    try:
        found = json.loads(body)
    except json.JSONDecodeError as e:
        raise ResolverError(f"no JSON at {e.pos}: {body[max(0, e.pos - 100) : e.pos + 100]!r}") from e
    if not isinstance(found, dict):
        raise ResolverError("the answer is no object")
    return found


class HttpResolver:
    """A chat-completion server."""

    def __init__(self, url: str, model: str = "", key: str = "EMPTY", timeout: float = 300.0):
        self.url, self.key, self.timeout = base_url(url), key, timeout
        self.model = picked_model([m["id"] for m in self._call("/models").get("data", [])], model)

    def _call(self, path: str, body: dict | None = None) -> dict:
        request = urllib.request.Request(self.url + path, data=json.dumps(body).encode() if body else None, headers={"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                return json.load(reply)
        except (urllib.error.URLError, OSError, ValueError) as e:
            raise ResolverError(str(e)) from e

    def resolve(self, system: str, user: str, schema: dict | None) -> str:
        shape = {"type": "json_schema", "json_schema": {"name": "answer", "strict": True, "schema": schema}} if schema else {"type": "json_object"}
        body = {"model": self.model, "temperature": 0.1, "stream": False, "response_format": shape, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]}
        try:
            return self._call("/chat/completions", body)["choices"][0]["message"]["content"]
        except (KeyError, IndexError, TypeError) as e:
            raise ResolverError("the answer has no content") from e


class RuleResolver:
    """Answers attribution requests by a rule: flagged lines alternate between the options."""

    def resolve(self, system: str, user: str, schema: dict | None) -> str:
        names = [n for n in re.findall(r"^- (.+)$", system, re.M) if n != "Unknown"]
        flagged = [int(n) for n in re.findall(r"^(\d+)\t[^\t\n]*\t[^\t\n]*\bASKED\b", user, re.M)]
        return json.dumps({"attributions": [{"index": i, "speaker": names[i % len(names)] if names else "Unknown"} for i in flagged]})


def attribution_schema(names: list[str]) -> dict:
    """The JSON schema of attributions with the allowed speakers."""
    options = [*dict.fromkeys(names), *([] if "Unknown" in names else ["Unknown"])]
    item = {"type": "object", "properties": {"index": {"type": "integer"}, "speaker": {"type": "string", "enum": options}}, "required": ["index", "speaker"], "additionalProperties": False}
    return {"type": "object", "properties": {"attributions": {"type": "array", "items": item}}, "required": ["attributions"], "additionalProperties": False}


#: What each kind of request asks, in this project's own words; {names} are the options, one a line.
SYSTEM = {
    "tags": "Some narration lines marked ASKED say that someone speaks without a name. Give the speaker of each.\n{names}",
    "attribute": "Give the speaker of every dialogue line marked ASKED. Lines marked CONTEXT are settled.\n{names}",
    "verify": "Independently give the speaker of every dialogue line marked ASKED; earlier answers are hidden.\n{names}",
    "settle": "Two readers disagree on the dialogue lines marked ASKED. Decide each from the text.\n{names}",
    "critic": "Check the speakers of this chapter. List corrections, objections to new names, and a quality from 0 to 1.\n{names}",
    "discover": "List the characters who speak or are addressed in this text, with other names used for them.",
    "chapters": "These are numbered lines of a book. List its chapters with their first lines.",
}


LINE_TEXT = 300


def rendered(flag: str = "ASKED", mask: bool = False) -> Column:
    """One prompt line of a segment (seg_idx, seg_type, text, speaker, notes, new_para, is_context, flagged).

    ``index <tab> kind <tab> marks <tab> speaker <tab> text``; a blank line stands before a new paragraph.
    The text is shown up to ``LINE_TEXT`` characters, since a prompt has a budget; the segment stays whole.
    """
    known = (F.col("seg_type") == "dialogue") & (F.coalesce("speaker", F.lit("")) != "")
    if mask:
        known &= ~F.col("flagged")
    marks = F.array_join(F.array_compact(F.array(F.when(F.col("is_context"), "CONTEXT"), F.when(F.col("flagged"), flag), F.when(F.col("notes") == "quote-continues", "OPEN"))), ",")
    shown = F.when(F.length("text") > LINE_TEXT, F.concat(F.left("text", F.lit(LINE_TEXT)), F.lit("…"))).otherwise(F.col("text"))
    line = F.concat_ws("\t", F.col("seg_idx").cast("string"), F.col("seg_type"), marks, F.when(known, F.col("speaker")).otherwise(""), shown)
    return F.concat(F.when(F.coalesce("new_para", F.lit(False)), "\n").otherwise(""), line)


def requests(segs: DataFrame, flagged: DataFrame, names: DataFrame, key: list[str], kind: str, budget: int = 1000) -> DataFrame:
    """(key, window_id, system, user, options): one request for each window that has something to resolve.

    The lines to resolve are marked, but for a critic, who reads all lines alike.
    """
    ids = Wn.segment_windows(segs, key, budget)
    asked = flagged.select(*key, "seg_idx").distinct().withColumn("flagged", F.lit(True))
    needed = ids.join(asked, [*key, "seg_idx"], "left_semi").select(*key, "window_id").distinct()
    rows = Wn.with_context(ids, key).join(needed, [*key, "window_id"], "left_semi")
    full = rows.join(segs, [*key, "seg_idx"]).join(asked, [*key, "seg_idx"], "left").withColumn("flagged", F.coalesce("flagged", F.lit(False)) & ~F.col("is_context") & F.lit(kind != "critic"))
    line = full.select(*key, "window_id", "seg_idx", rendered(mask=kind in ("verify", "settle")).alias("line"))
    user = line.groupBy(*key, "window_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", "line"))), lambda x: x["line"]), "\n").alias("user"))
    options = names.groupBy(*[k for k in key if k in names.columns]).agg(T.speaker_options(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"])).alias("options"))
    joined = user.join(options, [k for k in key if k in names.columns], "left").withColumn("options", F.coalesce("options", F.array(F.lit("Unknown"))))
    return joined.withColumn("system", F.lit(SYSTEM[kind]).substr(F.lit(1), F.lit(10_000))).withColumn("system", F.replace("system", F.lit("{names}"), F.array_join(F.transform("options", lambda n: F.concat(F.lit("- "), n)), "\n")))


def answered(reqs: DataFrame, factory: Callable[[], Resolver], key: list[str], retries: int = 3) -> DataFrame:
    """(key, seg_idx, speaker, ord): answers of all requests; one that fails ``retries`` times answers nothing.

    Speakers outside the options are dropped: a server may ignore the schema.
    """
    kinds = ", ".join(f"{k} {reqs.schema[k].dataType.simpleString()}" for k in key)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resolver = factory()
        for pdf in frames:
            out = []
            for r in pdf.to_dict("records"):
                options = list(r["options"])
                for _ in range(max(1, retries)):
                    try:
                        got = parsed_answer(resolver.resolve(r["system"], r["user"], attribution_schema(options)))
                    except ResolverError:
                        continue
                    for i, a in enumerate(got.get("attributions") or []):
                        if isinstance(a, dict) and isinstance(a.get("index"), int) and a.get("speaker") in options:
                            out.append([*(r[k] for k in key), a["index"], a["speaker"], i])
                    break
            yield pd.DataFrame(out, columns=[*key, "seg_idx", "speaker", "ord"])

    return reqs.select(*key, "system", "user", "options").mapInPandas(run, f"{kinds}, seg_idx int, speaker string, ord int")


_JUDGED = "seg_idx int, speaker string, ord int, issue string, verdict string, canonical string, quality double"


def critiques(reqs: DataFrame, factory: Callable[[], Resolver], key: list[str]) -> DataFrame:
    """(key, window_id, ...): what a critic says of each window, asked once; a window without an answer says nothing.

    One row per correction (seg_idx, speaker, ord), per objection (issue, verdict, canonical, ord) and
    per judged window (quality).
    """
    kinds = ", ".join(f"{k} {reqs.schema[k].dataType.simpleString()}" for k in [*key, "window_id"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resolver = factory()
        for pdf in frames:
            out = []
            for r in pdf.to_dict("records"):
                head = [*(r[k] for k in key), r["window_id"]]
                try:
                    got = parsed_answer(resolver.resolve(r["system"], r["user"], None))
                    quality = float(got.get("overall_quality", 1.0))
                except (ResolverError, TypeError, ValueError):
                    continue
                out.append([*head, None, None, None, None, None, None, quality])
                for i, c in enumerate(got.get("corrections") or []):
                    if isinstance(c, dict) and isinstance(c.get("index"), int) and c.get("speaker") in list(r["options"]):
                        out.append([*head, c["index"], c["speaker"], i, None, None, None, None])
                for i, c in enumerate(got.get("roster_issues") or []):
                    if isinstance(c, dict) and c.get("name") and c.get("verdict") in VERDICTS:
                        out.append([*head, None, None, i, c["name"], c["verdict"], c.get("canonical") or "", None])
            yield pd.DataFrame(out, columns=[*key, "window_id", "seg_idx", "speaker", "ord", "issue", "verdict", "canonical", "quality"])

    return reqs.select(*key, "window_id", "system", "user", "options").mapInPandas(run, f"{kinds}, {_JUDGED}")


def judged(segs: DataFrame, said: DataFrame, key: list[str], budget: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of a critic's words: corrections of the windows' own segments, objections in reading order, quality per chapter."""
    from quillspark.operators.attribution import quality

    ids = Wn.segment_windows(segs, key, budget)
    own = said.where("seg_idx is not null").join(ids, [*key, "window_id", "seg_idx"], "left_semi").select(*key, "seg_idx", "speaker", "ord")
    issues = said.where("issue is not null").select(*key, F.col("issue").alias("name"), "verdict", "canonical", F.struct("window_id", "ord").alias("ord"))
    talk = ids.join(segs.where("seg_type = 'dialogue'").select(*key, "seg_idx"), [*key, "seg_idx"], "left_semi").groupBy(*key, "window_id").agg(F.count("*").alias("dialogue"))
    windows = ids.select(*key, "window_id").distinct().join(talk, [*key, "window_id"], "left").join(said.where("quality is not null").select(*key, "window_id", "quality"), [*key, "window_id"], "left")
    return own, issues, quality(windows.withColumn("dialogue", F.coalesce("dialogue", F.lit(0))), key)


FIRST_LINES = 500


def proposed_chapters(lines: DataFrame, factory: Callable[[], Resolver], key: str) -> DataFrame:
    """(key, ord, title, start_line): chapters a model sees in the first lines of each book (key, at, line)."""
    numbered = lines.where(F.col("at") < FIRST_LINES).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: F.concat((x["at"] + 1).cast("string"), F.lit(": "), x["line"])), "\n").alias("user"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resolver = factory()
        for pdf in frames:
            out = []
            for book, user in zip(pdf[key], pdf["user"]):
                try:
                    got = parsed_answer(resolver.resolve(SYSTEM["chapters"], user, None))
                except ResolverError:
                    continue
                out += [(book, i, str(c.get("title") or ""), str(c.get("start_line"))) for i, c in enumerate(got.get("chapters") or []) if isinstance(c, dict)]
            yield pd.DataFrame(out, columns=[key, "ord", "title", "start_line"])

    return numbered.mapInPandas(run, f"{key} string, ord int, title string, start_line string")


def parsed(content: Column, ddl: str) -> Column:
    """An answer's JSON as a struct; null where it is none."""
    return F.from_json(T.strip_fences(content), ddl)
