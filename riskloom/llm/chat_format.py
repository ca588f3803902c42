"""Chat formatting by a grammar round trip, in SQL expressions only.

A conversation becomes one text: ``<s>`` and then its turns,

    system      [SYS] text [/SYS]          user        [INST] text [/INST]
    assistant    text</s>                  other role  [ROLE] role [/ROLE] text</s>

with one space on the inner side of each bracket. The grammar is regular: a text is split before each control string, and every piece
is read by its own and its neighbour's control string. Control strings inside texts and roles are escaped by stuffing: a control
string whose first character is followed by n backslashes gets n + 1, and the parser takes one away, so every text comes back.

Each turn is first rendered as it is and parsed again. Turns that do not come back are escaped; then the whole conversation is
rendered, parsed and compared to its source, and what still differs is escaped in all its turns. A conversation that
does not come back even then is an error, so what leaves this module is identical to what entered it.

The loss mask is kept as byte ranges of the formatted text, one per assistant turn, without the end mark. They are known before the
turns are joined, and a binary text is cut at them in constant time, so long conversations cost no more a turn than short ones.

Null texts and roles are empty; turns come in the order of turn (nulls first), then role and text; repeated rows are turns of their own; null conversation
ids are one conversation; an empty table gives no rows; other columns are not looked at. A formatted conversation is one value, so it must be
shorter than a string may be (2 GB), and the task that joins it holds it: the format asks for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.shared import Stored, read

#: Control strings, and what follows their first character.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")
_TAILS = "|".join(c[1:].replace("]", r"\]") for c in CONTROLS)
BARE = rf"[<\[](?:{_TAILS})"
STUFFED = rf"([<\[])(\\*)({_TAILS})"
UNSTUFF = rf"([<\[])\\(\\*)({_TAILS})"


def stuff(text: Column) -> Column:
    """``text`` with one more backslash in each control string."""
    return F.regexp_replace(text, STUFFED, r"$1\\$2$3")


def unstuff(text: Column) -> Column:
    return F.regexp_replace(text, UNSTUFF, "$1$2$3")


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def rendered(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """(before, text, after) of a turn; the loss falls on the text of assistant turns."""
    before = F.when(role == "system", "[SYS] ").when(role == "user", "[INST] ").when(role == "assistant", " ").otherwise(F.concat(F.lit("[ROLE] "), role, F.lit(" [/ROLE] ")))
    after = F.when(role == "system", " [/SYS]").when(role == "user", " [/INST]").otherwise("</s>")
    return before, text, after


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text), or null where the text is no conversation.

    One split and one look at each piece and its neighbours; nothing is searched twice.
    """
    pieces = F.split(formatted, rf"(?={BARE})")

    def read_pieces(p: Column) -> Column:
        mark = F.transform(p, lambda x: F.regexp_extract(x, rf"^({BARE})", 1))
        rest = F.transform(p, lambda x: F.regexp_replace(x, rf"^{BARE}", ""))
        return _let(F.struct(mark.alias("mark"), rest.alias("rest")), turns)

    def at(items: Column, i: Column) -> Column:
        return F.get(items, i)

    def inner(text: Column) -> Column:
        """A text between brackets without its two spaces."""
        return F.when(text.startswith(" ") & text.endswith(" ") & (F.length(text) >= 2), unstuff(F.substring(text, F.lit(2), F.length(text) - 2)))

    def led(text: Column) -> Column:
        """A text before an end mark, without the space that leads it."""
        return F.when(text.startswith(" "), unstuff(F.substring(text, F.lit(2), F.length(text))))

    def turns(s: Column) -> Column:
        mark, rest = s["mark"], s["rest"]

        def turn(m: Column, i: Column) -> Column:
            # A turn is read where it ends; the pieces that begin or name one give nothing themselves.
            before = at(mark, i - 1)
            named = before == "[/ROLE]"
            closing = F.when(m == "[/SYS]", F.when(before == "[SYS]", F.struct(F.lit("system").alias("role"), inner(at(rest, i - 1)).alias("text"))))
            closing = closing.when(m == "[/INST]", F.when(before == "[INST]", F.struct(F.lit("user").alias("role"), inner(at(rest, i - 1)).alias("text"))))
            return closing.when(
                m == "</s>",
                F.when(named, F.struct(F.when(at(mark, i - 2) == "[ROLE]", inner(at(rest, i - 2))).alias("role"), led(at(rest, i - 1)).alias("text"))).when(
                    before.isin("<s>", "</s>", "[/INST]", "[/SYS]"), F.struct(F.lit("assistant").alias("role"), led(at(rest, i - 1)).alias("text"))
                ),
            )

        def fits(m: Column, i: Column) -> Column:
            """What may stand where: a text after a closing mark only before an end mark, brackets in pairs, nothing before the begin mark."""
            after = F.coalesce(at(mark, i + 1), F.lit(""))
            ends = (after == "</s>") == (at(rest, i) != "")
            return (
                F.when(i == 0, (m == "<s>") & ends)
                .when(m == "[SYS]", after == "[/SYS]").when(m == "[INST]", after == "[/INST]").when(m == "[ROLE]", after == "[/ROLE]").when(m == "[/ROLE]", after == "</s>")
                .when(m.isin("[/SYS]", "[/INST]", "</s>"), ends)
                .otherwise(False)
            )

        found = F.filter(F.transform(mark, turn), lambda t: t.isNotNull())
        fine = F.forall(F.transform(mark, fits), lambda ok: ok) & F.forall(found, lambda t: t["role"].isNotNull() & t["text"].isNotNull())
        return F.when(fine, found)

    return _let(pieces, read_pieces)


def _joined(rows: DataFrame) -> DataFrame:
    """(conv_id, turns, formatted, loss) of rows (conv_id, turn, role, text, escape), by one shuffle on conv_id.

    Running byte lengths come from a window over the rows in order, and the texts are joined under the same partitioning.
    """
    role, text = [F.when(F.col("escape"), stuff(F.col(c))).otherwise(F.col(c)) for c in ("role", "text")]
    rows = rows.select("conv_id", "turn", "role", "text", role.alias("safe_role"), text.alias("safe_text"))
    before, text, after = rendered(F.col("safe_role"), F.col("safe_text"))
    rows = rows.withColumn("whole", F.concat(before, text, after)).withColumn("lead", F.octet_length(before)).withColumn("many", F.octet_length(text))
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = F.sum(F.octet_length("whole").cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("place", F.row_number().over(in_order)).withColumn("start", upto - F.octet_length("whole") + F.lit(len("<s>")) + F.col("lead"))
    loss = F.when(F.col("role") == "assistant", F.struct(F.col("start").cast("long").alias("start"), F.col("many").cast("long").alias("length")))
    # The rows of a conversation arrive in order, and sorting the collected ones keeps it so whatever the plan.
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "turn", "role", "text", "whole", loss.alias("loss")))).alias("held"))
    return held.select(
        "conv_id",
        F.transform("held", lambda t: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        F.concat(F.lit("<s>"), F.array_join(F.transform("held", lambda t: t["whole"]), "")).alias("formatted"),
        F.filter(F.transform("held", lambda t: t["loss"]), lambda x: x.isNotNull()).alias("loss"),
    )


def _comes_back(formatted: Column, turns: Column) -> Column:
    source = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return F.coalesce(parsed(formatted) == source, F.lit(False))


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss), ``loss`` being the byte ranges (start, length) of the formatted text that are learned.

    The table is stored, so what reads it back several times does not format it again.
    """
    stored = Stored(conversations.sparkSession, "chats")
    rows = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    alone = F.concat(F.lit("<s>"), *rendered(F.col("role"), F.col("text")))
    clash = ~_comes_back(alone, F.array(F.struct("role", "text")))
    first = _joined(rows.withColumn("escape", clash)).withColumn("same", _comes_back(F.col("formatted"), F.col("turns")))
    first, _ = stored.put(first.select("conv_id", *[F.when(F.col("same"), F.col(c)).alias(c) for c in ("formatted", "loss")], F.when(~F.col("same"), F.col("turns")).alias("turns")))
    # What still differs is escaped in all its turns; after that, a difference is an error.
    again = _joined(first.where(F.col("formatted").isNull()).select("conv_id", F.inline("turns")).withColumn("escape", F.lit(True)))
    failed = F.raise_error(F.lit("a conversation does not come back from its format")).cast("string")
    checked = F.when(_comes_back(F.col("formatted"), F.col("turns")), F.col("formatted")).otherwise(failed)
    kept = ["conv_id", "formatted", "loss"]
    return first.where(F.col("formatted").isNotNull()).select(*kept).unionByName(again.select("conv_id", checked.alias("formatted"), "loss"))


def learned_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, cut out of the bytes of a formatted conversation."""
    cut = lambda b: F.transform(loss, lambda x: unstuff(F.substring(b, (x["start"] + 1).cast("int"), x["length"].cast("int")).cast("string")))
    return F.array_join(_let(formatted.cast("binary"), cut), "")


def op13_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation and one full of control strings, formatted and read back."""
    rows = read(spark, folder, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    chats = format_chats(rows.unionByName(odd))
    back = chats.select("conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("loss")).alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP13_SQL = r"""
WITH rows_ AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, length(regexp_replace(text, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|SYS\]|/SYS\]|ROLE\]|/ROLE\])', '\1\\\2\3', 'g'))
        + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 5
            ELSE 20 + length(regexp_replace(role, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|SYS\]|/SYS\]|ROLE\]|/ROLE\])', '\1\\\2\3', 'g')) END AS size
    FROM rows_
), joined AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned, 3 + sum(size) AS formatted_chars
    FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM joined
"""
