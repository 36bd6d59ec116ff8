from conftest import SF_SMALL

from tessera.llm import preference, queries


def write(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def learnt(turns):
    at, out = 0, []
    for role, text in turns:
        full = write([(role, text)])
        if role == "assistant":
            out.append((at + len(f"<|{role}|>\n"), at + len(full)))
        at += len(full)
    return out


def brute_pair(chosen, rejected):
    chosen = [(r or "unknown", t or "") for r, t in chosen or []]
    rejected = [(r or "unknown", t or "") for r, t in rejected or []]
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    return (n, write(chosen[:n]), write(chosen[n:]), learnt(chosen[n:]), write(rejected[n:]), learnt(rejected[n:]))


def stale(turns):
    said = [i for i, (r, _) in enumerate(turns) if r == "assistant"]
    if not said:
        return turns
    kept = turns[:said[-1]]
    return kept + [("assistant", turns[said[-2]][1])] if len(said) > 1 else kept


def rows_of(frame):
    return {r[0]: (r.n_prompt_turns, r.prompt, r.chosen, [tuple(x) for x in r.chosen_learnt], r.rejected,
                   [tuple(x) for x in r.rejected_learnt]) for r in frame.collect()}


def test_query_equals_brute_force(spark):
    told = {}
    for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect():
        told.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    want = {}
    for i, turns in told.items():
        own = [(r, t) for _, r, t in sorted(turns)]
        want[i] = brute_pair(own, stale(own))
    assert rows_of(queries.op6_preference_pairs(spark, SF_SMALL)) == want


def test_pairs_with_nulls_and_equal_sides(spark):
    pairs = {1: ([("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "b")]),
             2: ([("user", "q")], [("user", "q")]), 3: (None, [("assistant", "é\U0001f600")]), 4: ([], []),
             5: ([(None, None), ("assistant", "x" * 50_000)], [("unknown", ""), ("assistant", None)])}
    frame = spark.createDataFrame([(i, c, r, "z") for i, (c, r) in pairs.items()],
                                  f"pair long, chosen {preference.TURNS}, rejected {preference.TURNS}, c string")
    assert rows_of(preference.format_pairs(frame, "pair")) == {i: brute_pair(*p) for i, p in pairs.items()}


def test_conversations_with_repeats_and_without_an_id(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "x"),
            (None, 0, "user", "y"), (2, None, None, None)]
    told = preference.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = sorted(((r.conv_id, [tuple(t) for t in r.turns]) for r in told.collect()), key=repr)
    assert got == sorted([(1, [("user", "a"), ("assistant", "b")]), (None, [("user", "x")]), (None, [("user", "y")]),
                          (2, [("unknown", "")])], key=repr)
    assert preference.conversations(spark.createDataFrame(
        [], "conv_id long, turn long, role string, text string")).count() == 0
