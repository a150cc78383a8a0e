"""Conversation structure repair over a suffix-shared automaton.

A conversation's rows, taken by turn, become a signature: one character per row
for its role and its first fault (``D`` for a row that must go: blank, or role and
text seen earlier; else the initial of its role, or ``o`` for another role, in
capitals when the text is truncated). What the cheapest edits of the remaining
rows are depends on the remaining signature and the state of the grammar
``(s?(ua)+)?`` alone. So the distinct signatures of all conversations are sorted
by their reversed form and walked in that order: signatures with a common ending
share the automaton's nodes for it, and each node gets, once per grammar state,
its cost-to-go and the first edit of its best audit suffix with the state that
follows; the rest of the suffix is the node behind. Only the nodes of the present
ending are held, so memory is that of one signature.

Edits: keep 0, rerole (to user or assistant) 1, delete 2 (required for blank and
duplicate rows), insert an empty user or assistant row 5; a truncated row that is
not deleted adds 5. Of edits of equal cost the audit (K, R, D, I) that is least in
ASCII wins. A first letter leaves one successor only, so it decides the tie.

Rows meet their conversation in sorted partitions that are read as a stream: a
conversation of any length is never held, neither its texts nor its rows; only its
signature and audit are (a byte per row). Repeated rows are found by a window over
(conversation, role, digest of the text), which spreads a long conversation. The
digest of a repaired conversation is one hash over its text, so its rows pass
through one task one after the other.

Defined results: null roles and texts are one space; rows without a turn come
first; rows of one turn come by role and by the digest of their text; rows without
a conversation id are one conversation (id null); repeated rows are rows of their
own (and duplicates). A conversation without rows has zeros, an empty audit and
the digest of the empty text. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartstreak.llm.common import quoted, table
from chartstreak.session import materialise, workers_import_package

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# Grammar states: nothing yet, after a system row, after a user row, after an assistant row.
FOLLOWS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ANSWER = {**FOLLOWS["u"], **FOLLOWS["a"]}  # the state behind a reroled or inserted row
ROLE_INTO = {2: "user", 3: "assistant"}
ENDS = (0, 3)
SYMBOLS, LEGAL = "sua", ("su", "ua", "au")
NEVER = (1 << 60, "~", -1)


def with_inserts(best: list) -> list:
    """(cost, edit, next state) per state, with insertions before the edit where they are better."""
    while True:
        now = [min(best[s], (INSERT + best[ANSWER[s]][0], "I", ANSWER[s])) for s in range(4)]
        if now == best:
            return now
        best = now


END = with_inserts([(0, "", s) if s in ENDS else NEVER for s in range(4)])


def node(symbol: str, behind: list) -> list:
    """The automaton's node for ``symbol`` before the suffix of node ``behind``."""
    best = [(DELETE + behind[s][0], "D", s) for s in range(4)]
    if symbol != "D":
        extra = TRUNCATED if symbol.isupper() else 0
        for s, after in FOLLOWS.get(symbol.lower(), {}).items():
            best[s] = min(best[s], (KEEP + extra + behind[after][0], "K", after))
        for s, after in ANSWER.items():
            best[s] = min(best[s], (REROLE + extra + behind[after][0], "R", after))
    return with_inserts(best)


def audit_of(path: list) -> str:
    """The best audit of the signature whose nodes are ``path`` (from the end to its first symbol)."""
    out, at, state = [], len(path) - 1, 0
    while True:
        _, edit, state = path[at][state]
        if not edit:
            return "".join(out)
        out.append(edit)
        at -= edit != "I"


def solve(reversed_signatures):
    """(cost, audit, new nodes) of each of the sorted, reversed signatures."""
    path, last = [END], ""
    for backwards in reversed_signatures:
        shared = 0
        while shared < min(len(last), len(backwards)) and last[shared] == backwards[shared]:
            shared += 1
        del path[shared + 1:]
        for symbol in backwards[shared:]:
            path.append(node(symbol, path[-1]))
        last = backwards
        yield path[-1][0][0], audit_of(path), len(backwards) - shared


def _solved(batches):
    def reversed_signatures():
        for frame in batches:
            yield from frame["backwards"]
    out = []
    for backwards, (cost, audit, _) in _paired(reversed_signatures()):
        out.append((backwards[::-1], cost, audit))
        if len(out) == 1000:
            yield pd.DataFrame(out, columns=["signature", "cost", "audit"])
            out = []
    yield pd.DataFrame(out, columns=["signature", "cost", "audit"])


def _paired(source):
    """Each item of ``source`` with what ``solve`` says of it."""
    seen = []

    def passing():
        for item in source:
            seen.append(item)
            yield item
    for answer in solve(passing()):
        yield seen.pop(), answer


def solve_signatures(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of the distinct values of column ``signature``."""
    workers_import_package(signatures.sparkSession)
    backwards = signatures.select(F.reverse("signature").alias("backwards")).distinct()
    backwards = materialise(backwards, "signatures")
    return (backwards.repartitionByRange("backwards").sortWithinPartitions("backwards")
            .mapInPandas(_solved, "signature string, cost long, audit string"))


def _key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("c"), conv.cast("string")), F.lit("n"))


def conversation_rows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text") -> DataFrame:
    """(key, conv_id, turn, role, text), nulls as the module says."""
    conv = F.col(quoted(conv_col))
    return turns.select(_key(conv).alias("key"), conv.alias("conv_id"), F.col(quoted(turn_col)).cast("long").alias("turn"),
                        F.coalesce(F.col(quoted(role_col)).cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(" ")).alias("text"))


def damage(rows: DataFrame, modulus: int = 20) -> DataFrame:
    """Deterministic faults by crc32 of ``conv_id:turn``: dropped, emptied, unpunctuated, repeated, reroled rows."""
    def name(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % modulus
    fated = rows.withColumn("fate", fate).where("fate != 0")
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (fated.withColumn("text", text.otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")))
            .withColumn("time", F.explode(times)).drop("time", "fate"))


SPACE = r"\x20\x09-\x0D"


def in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Rows of a conversation in one sorted partition."""
    return rows.repartition("key").sortWithinPartitions(
        "key", *first, F.col("turn").asc_nulls_first(), "role", "code")


def marked(rows: DataFrame) -> DataFrame:
    """Rows without their text: digest, fault and symbol of each."""
    digest = F.unhex(F.sha2("text", 256))
    light = rows.select(
        "key", "turn", "role", digest.alias("code"), F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("open"))
    earlier = Window.partitionBy("key", "role", "code").orderBy(F.col("turn").asc_nulls_first())
    fault = (F.when(F.col("blank"), "blank").when(F.row_number().over(earlier) > 1, "duplicate")
             .when(F.col("open"), "truncated").otherwise(""))
    letter = F.when(F.col("initial").isin(*SYMBOLS), F.col("initial")).otherwise(F.lit("o"))
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), F.lit("D"))
              .when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter))
    return light.withColumn("fault", fault).withColumn("symbol", symbol).drop("blank", "open")


class _Report:
    """Counts of one conversation, row by row."""

    def __init__(self, key):
        self.key, self.faults = key, {"": 0, "blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.turns, self.first, self.last, self.before, self.signature = 0, 0, None, None, None, []

    def add(self, turn, has_turn, initial, fault, symbol):
        self.faults[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        self.signature.append(symbol)
        if has_turn and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.key, gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal,
                "".join(self.signature))


REPORT = ["key", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"]


def _reports(batches):
    report, out = None, []
    for frame in batches:
        for key, *row in zip(frame["key"], frame["turn"], frame["has_turn"], frame["initial"], frame["fault"],
                             frame["symbol"]):
            if report is None or key != report.key:
                if report:
                    out.append(report.row())
                report = _Report(key)
            report.add(*row)
        yield pd.DataFrame(out, columns=REPORT)
        out = []
    if report:
        yield pd.DataFrame([report.row()], columns=REPORT)


def fault_reports(rows: DataFrame) -> DataFrame:
    """One row per conversation with rows: gaps, faults, illegal neighbours and the signature."""
    workers_import_package(rows.sparkSession)
    light = in_order(marked(rows)).select("key", F.coalesce("turn", F.lit(0)).alias("turn"),
                                          F.col("turn").isNotNull().alias("has_turn"), "initial", "fault", "symbol")
    return light.mapInPandas(_reports, "key string, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                       "signature string")


def _repaired(batches):
    """Repaired rows (key, position, edit, role, text); each conversation's audit comes before its rows."""
    key, audit, at, state, position = None, "", 0, 0, 0
    out: list = []

    def inserts():
        nonlocal at, state, position
        while at < len(audit) and audit[at] == "I":
            state = ANSWER[state]
            out.append((key, position, "I", ROLE_INTO[state], ""))
            at, position = at + 1, position + 1

    for frame in batches:
        for its_key, kind, role, text in zip(frame["key"], frame["kind"], frame["role"], frame["text"]):
            if kind == 0:
                inserts()
                key, audit, at, state, position = its_key, text, 0, 0, 0
                continue
            inserts()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            state = FOLLOWS[role[:1]][state] if edit == "K" else ANSWER[state]
            out.append((key, position, edit, role if edit == "K" else ROLE_INTO[state], text))
            position += 1
        yield pd.DataFrame(out, columns=["key", "position", "edit", "role", "text"])
        out.clear()
    inserts()
    yield pd.DataFrame(out, columns=["key", "position", "edit", "role", "text"])


def _digests(batches):
    """SHA-256 of each conversation's ``role:text`` lines."""
    key, digest = None, None
    for frame in _repaired(batches):
        out = []
        for its_key, role, text in zip(frame["key"], frame["role"], frame["text"]):
            line = f"{role}:{text}".encode()
            if its_key == key:
                digest.update(b"\n" + line)
            else:
                if digest:
                    out.append((key, digest.hexdigest()))
                key, digest = its_key, hashlib.sha256(line)
        yield pd.DataFrame(out, columns=["key", "repaired_sha256"])
    if digest:
        yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "repaired_sha256"])


def _with_audits(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Rows in order behind a row with their conversation's audit."""
    workers_import_package(rows.sparkSession)
    turns = rows.select("key", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("code"), "text")
    head = solved.select("key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.unhex(F.lit("")).alias("code"), F.col("audit").alias("text"))
    return in_order(turns.union(head), "kind").select("key", "kind", "role", "text")


def plan_repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation with rows: its report, ``cost`` and ``audit``; written once."""
    reports = materialise(fault_reports(rows), "fault-reports")
    solved = materialise(solve_signatures(reports), "solved-signatures").hint("merge")
    return materialise(reports.join(solved, "signature"), "repair-plans")


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: key, position, edit (K, R or I), role, text."""
    return _with_audits(rows, plans).mapInPandas(
        _repaired, "key string, position long, edit string, role string, text string")


def repaired_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(key, repaired_sha256) of the conversations that have rows after their repair."""
    return _with_audits(rows, plans).mapInPandas(_digests, "key string, repaired_sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per id of ``conversations``, whose rows to repair are ``rows``."""
    plans = plan_repairs(rows)
    every = conversation_rows(conversations).groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    joined = every.join(plans, "key", "left").join(repaired_digests(rows, plans), "key", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations, damage(conversation_rows(conversations)))


def _sql() -> str:
    """The same by a fold over each conversation's rows from its end, one list of four states per row."""
    into = {0: 2, 1: 2, 2: 3, 3: 2}
    role = {2: "user", 3: "assistant"}

    def option(cost, letter, after, line=None):
        r = f"b[{after + 1}].r" if line is None else f"list_prepend({line}, b[{after + 1}].r)"
        return f"{{'c': b[{after + 1}].c + {cost}, 'a': '{letter}' || b[{after + 1}].a, 'r': {r}}}"

    def edits(s):
        kept = {0: "case when f = 's' then {0} when f = 'u' then {1} end", 2: "case when f = 'a' then {2} end"}.get(
            s, "case when f = 'u' then {1} end").format(
            *[option("x", "K", after, "role || ':' || text") for after in (1, 2, 3)])
        reroled = option("1 + x", "R", into[s], f"'{role[into[s]]}:' || text")
        return f"list_min([{option(2, 'D', s)}, case when stays then {kept} end, case when stays then {reroled} end])"

    def relaxed(source):
        new = [f"list_min([b[{s + 1}], {option(5, 'I', into[s], repr(role[into[s]] + ':'))}])" for s in range(4)]
        return f"select conv_id, i, [{', '.join(new)}] as b from ({source})"

    step = f"""select d.conv_id, d.i - 1 as i, [{', '.join(edits(s) for s in range(4))}] as b
      from dp d join (select conv_id, i as at, role, text, left(role, 1) as f, fault in ('', 'truncated') as stays,
                        case when fault = 'truncated' then 5 else 0 end as x from faulted) r
        on r.conv_id is not distinct from d.conv_id and r.at = d.i - 1"""
    crc = """xor(4294967295, list_reduce(
        list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':'
                                    || coalesce(cast(turn as varchar), ' '), ''), lambda x: cast(ascii(x) as bigint)),
        lambda c, b: list_reduce([cast(i as bigint) for i in range(8)],
                                 lambda a, i: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end,
                                 xor(c, b)), 4294967295))"""
    return f"""
with recursive src as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc} % 20 as fate
  from conversations),
damaged as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
    case when fate = 1 then '' when fate = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from src where fate <> 0
  union all select conv_id, turn, role, text from src where fate = 3),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i
           from damaged),
faulted as (
  select *, lag(left(role, 1)) over (partition by conv_id order by i) as before,
    case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank'
         when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
         when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') then 'truncated' else '' end as fault
  from placed),
counted as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count_if(fault = 'blank') as blank, count_if(fault = 'duplicate') as duplicate,
    count_if(fault = 'truncated') as truncated,
    count_if(before || left(role, 1) not in ('su', 'ua', 'au')) as illegal
  from faulted group by conv_id),
dp as (
  select conv_id, n + 1 as i, [{{'c': 0, 'a': '', 'r': cast([] as varchar[])}},
    {{'c': 10, 'a': 'II', 'r': ['user:', 'assistant:']}}, {{'c': 5, 'a': 'I', 'r': ['assistant:']}},
    {{'c': 0, 'a': '', 'r': cast([] as varchar[])}}] as b from counted
  union all
  {relaxed(relaxed(relaxed(step)))}),
solved as (select conv_id, b[1].c as cost, b[1].a as audit, array_to_string(b[1].r, chr(10)) as repaired
           from dp where i = 1)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
  coalesce(audit, '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from (select distinct conv_id from conversations) e
left join counted c on c.conv_id is not distinct from e.conv_id
left join solved s on s.conv_id is not distinct from e.conv_id"""


OP13_SQL = _sql()
