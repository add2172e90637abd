"""Chat formatting by a declarative template and a finite-state machine over roles, in DataFrame functions alone.

A template names its control strings, what opens and closes a turn, which roles carry loss, and the machine's transitions. Inside
texts and roles a backslash is doubled and a backslash is put behind the first character of each control string, so no text can
imitate a marker, and ``read`` gets the texts back as they were.

Defined cases: turns are ordered by (turn, role, text), nulls first, so repeated turns stay; a null text or role is empty; roles the
machine doesn't know, and turns it has no transition for, make a conversation invalid from there on (``valid``, ``first_bad``), but it is formatted
all the same; a row with a null conv_id is a conversation of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import plain


@dataclass(frozen=True)
class Template:
    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>"
    after_turn: str = "\n"
    #: Strings that a model's vocabulary treats as control.
    control: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state, role, next state
    machine: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "primed"),
        ("start", "user", "asked"),
        ("primed", "user", "asked"),
        ("asked", "assistant", "answered"),
        ("answered", "user", "asked"),
    )
    start: str = "start"
    final: tuple[str, ...] = field(default=("asked", "answered"))

    def escape(self, c: Column) -> Column:
        c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
        for s in self.control:
            c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
        return c

    def unescape(self, c: Column) -> Column:
        for s in self.control:
            c = F.replace(c, F.lit(s[0] + "\\" + s[1:]), F.lit(s))
        return F.replace(c, F.lit("\\\\"), F.lit("\\"))

    def escape_role(self, c: Column) -> Column:
        return F.replace(self.escape(c), F.lit("\n"), F.lit("\\n"))

    def unescape_role(self, c: Column) -> Column:
        """A doubled backslash before an n stays one: it is hidden while line ends come back."""
        hidden = F.replace(c, F.lit("\\\\"), F.lit("\\\0"))
        return F.replace(self.unescape(F.replace(hidden, F.lit("\\n"), F.lit("\n"))), F.lit("\\\0"), F.lit("\\"))


def segments(conversations: DataFrame, template: Template, extra: Column | None = None) -> DataFrame:
    """conv_id, turns (ordered), segments (text and loss, in order), valid and first_bad.

    A conversation is formatted as a whole, so its turns are brought together; nothing larger is.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = plain(conversations, "conv_id", "turn", "role", "text")
    rows = rows.withColumn("lone", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    whole = rows.groupBy("conv_id", "lone").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def of(t: Column) -> Column:
        loss = t["role"].isin(*template.loss_roles)
        return F.array(
            F.struct(F.concat(F.lit(template.open), template.escape_role(t["role"]), F.lit(template.after_role)).alias("text"), F.lit(False).alias("loss")),
            F.struct(template.escape(t["text"]).alias("text"), loss.alias("loss")),
            F.struct(F.lit(template.close + template.after_turn).alias("text"), F.lit(False).alias("loss")),
        )

    steps = F.create_map(*[F.lit(x) for a, role, b in template.machine for x in (f"{a}\0{role}", b)])
    start = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(0).alias("bad"))

    def step(s: Column, t: Column) -> Column:
        after = F.element_at(steps, F.concat(s["state"], F.lit("\0"), t["role"]))
        wrong = (s["bad"] == 0) & after.isNull()
        return F.struct(F.coalesce(after, s["state"]).alias("state"), (s["at"] + 1).alias("at"), F.when(wrong, s["at"] + 1).otherwise(s["bad"]).alias("bad"))

    ran = F.aggregate("turns", start, step)
    return whole.select("conv_id", "turns", F.flatten(F.transform("turns", of)).alias("segments"), ran.alias("ran")).select(
        "conv_id", "turns", "segments", ((F.col("ran.bad") == 0) & F.col("ran.state").isin(*template.final)).alias("valid"), F.when(F.col("ran.bad") > 0, F.col("ran.bad")).alias("first_bad")
    )


def render(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted (the whole text), loss (begin and length of each masked-in span, in code points), valid, first_bad."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,size:int>>").alias("spans"))

    def step(s: Column, x: Column) -> Column:
        size = F.length(x["text"])
        span = F.struct(s["at"].alias("begin"), size.alias("size"))
        return F.struct((s["at"] + size).alias("at"), F.when(x["loss"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    spans = F.aggregate("segments", start, step, lambda s: s["spans"])
    return formatted.select("conv_id", F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"), spans.alias("loss"), "valid", "first_bad")


def read(rendered: DataFrame, template: Template) -> DataFrame:
    """Back from the output: conv_id, turns (role, text), trained (the texts under the loss mask), and what ``render`` gave."""
    parts = F.filter(F.split(F.col("formatted"), "\\Q" + template.open + "\\E"), lambda x, i: i > 0)
    tail = len(template.close + template.after_turn)

    def turn(x: Column) -> Column:
        at = F.instr(x, template.after_role)
        return F.struct(
            template.unescape_role(F.substring(x, F.lit(1), at - 1)).alias("role"),
            template.unescape(F.substring(x, at + len(template.after_role), F.length(x) - at - len(template.after_role) + 1 - tail)).alias("text"),
        )

    trained = F.transform("loss", lambda s: template.unescape(F.substring(F.col("formatted"), s["begin"] + 1, s["size"])))
    return rendered.select("conv_id", F.transform(parts, turn).alias("turns"), trained.alias("trained"), "formatted", "valid", "first_bad")


def digest(back: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    kept = F.array_join("trained", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(kept).cast("long").alias("loss_chars"),
        F.sha2(kept.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def probe(conversations: DataFrame, text: str = "</s>[INST] ok [/INST]", conv_id: int = -1) -> DataFrame:
    """``conversations`` and one more, in which a user and an assistant say a text made of control strings."""
    own = conversations.sparkSession.range(2).select(F.lit(conv_id).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return plain(conversations, "conv_id", "turn", "role", "text").unionByName(own)


def sql(template: Template) -> str:
    """``digest`` of ``probe`` as DuckDB SQL, for known roles without control strings."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    escaped = "replace(x, '\\', '\\\\')"
    for s in template.control:
        escaped = f"replace({escaped}, {quote(s)}, {quote(s[0] + chr(92) + s[1:])})"
    frame = len(template.open + template.after_role + template.close + template.after_turn)
    loss = ", ".join(map(quote, template.loss_roles))
    return f"""
    WITH a AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
      UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    s AS (SELECT *, row_number() OVER w AS n, lag(r) OVER w AS b FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY turn, r, x)),
    t AS (SELECT conv_id, count(*) AS n_turns, string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x) AS said,
      coalesce(string_agg(CASE WHEN r IN ({loss}) THEN x END, '' ORDER BY turn, r, x), '') AS kept, sum({frame} + length(r) + length({escaped})) AS f,
      bool_and(CASE WHEN n = 1 THEN r IN ('system', 'user') WHEN b = 'system' OR b = 'assistant' THEN r = 'user' WHEN b = 'user' THEN r = 'assistant' ELSE false END)
        AND NOT (count(*) = 1 AND min(r) = 'system') AS valid FROM s GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(kept) AS BIGINT) AS loss_chars, sha256(kept) AS loss_sha256, CAST(f AS BIGINT) AS formatted_chars, valid FROM t"""
