import random

from pyspark.sql import functions as F

from tessera import config as C
from tessera.operators import pack as P
from tessera.operators.budget import apply_budget


def seq_cap(rows, cap):
    """Sequential model: stop right after the kept row whose running chars/4 reaches the cap."""
    out, chars = [], 0
    for pos, kept, cc in rows:
        out.append(pos)
        if kept:
            chars += cc
            if chars / C.CHARS_PER_TOKEN >= cap:
                break
    return out


def test_budget_cap_matches_loop(spark):
    rng = random.Random(5)
    data, caps = [], []
    for shard in range(6):
        cap = [0, 250, 1000, 10**9, 300, 375][shard]
        caps.append(("s", shard, cap))
        for pos in range(40):
            kept = rng.random() < 0.6
            data.append(("s", shard, pos * 3 + shard, kept, rng.choice([600, 800, 1000, 1200]) if kept else 0))
    df = spark.createDataFrame(data, "source string, shard int, pos long, kept boolean, clean_chars long")
    cp = spark.createDataFrame(caps, "source string, shard int, per_shard_cap long")
    for bucket in (1 << 20, 7):
        got = {}
        for r in apply_budget(df.repartition(5), cp, bucket).collect():
            got.setdefault(r.shard, []).append(r.pos)
        for shard, _, cap in [(c[1], None, c[2]) for c in caps]:
            rows = sorted((p, k, cc) for s_, sh, p, k, cc in data if sh == shard)
            assert sorted(got.get(shard, [])) == seq_cap(rows, cap), (bucket, shard)


def pack_loop(docs, L, val_every, eos=1):
    buf, wins, w = [], [], 0
    for ids in docs:
        buf.extend(ids + [eos])
        while len(buf) >= L:
            wins.append((w, "val" if w % val_every == 0 else "train", buf[:L]))
            buf = buf[L:]
            w += 1
    return wins


def test_pack_matches_loop(spark):
    rng = random.Random(3)
    docs = [[rng.randint(7, 300) for _ in range(rng.choice([0, 1, 5, 30, 64, 200]))] for _ in range(60)]
    rows = [("s", 0, 0, i, d) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "source string, tok_shard int, shard int, line_idx long, ids array<int>")
    for bucket in (1 << 16, 4):
        got = sorted((r.window_id, r.split, list(r.ids))
                     for r in P.pack_windows(df.repartition(3), "ids", 64, 1, 10, bucket).collect())
        assert got == pack_loop(docs, 64, 10), bucket


def test_line_index_two_level(spark):
    rows = [("s", sh, p) for sh in range(2) for p in range(0, 300, 7)]
    df = spark.createDataFrame(rows, "source string, shard int, pos long")
    got = P.line_index(df.repartition(4), bucket_rows=16).collect()
    for r in got:
        assert r.line_idx == r.pos // 7


def test_epoch_plan_edges(spark):
    from tessera.operators.evalplan import epoch_plan
    n = 37  # not divisible by world x per_gpu = 8
    rows = [("s", 0, w, "train", [1]) for w in range(n)] + [("s", 0, 100, "val", [1])]
    win = spark.createDataFrame(rows, "source string, tok_shard int, window_id long, split string, ids array<int>")
    full = epoch_plan(win, world_size=2, per_gpu_windows=4, micro_batch=2).collect()
    assert len(full) == (n // 8) * 8
    assert sorted(r.global_pos for r in full) == list(range((n // 8) * 8))
    for r in full:
        assert r.rank == r.global_pos % 2 and r.step == (r.global_pos // 2) // 4 and r.micro == ((r.global_pos // 2) % 4) // 2
    capped = epoch_plan(win, world_size=2, per_gpu_windows=4, micro_batch=2, max_steps=2, start_step=1).collect()
    assert sorted({r.step for r in capped}) == [1] and len(capped) == 8
    # the shuffle is a permutation of the train windows, independent of input partitioning
    again = epoch_plan(win.repartition(5), world_size=2, per_gpu_windows=4, micro_batch=2).collect()
    assert sorted((r.window_id, r.global_pos) for r in again) == sorted((r.window_id, r.global_pos) for r in full)


def test_perplexity_rollup_weighted(spark):
    import math

    from tessera.operators.evalplan import perplexity_rollup
    rows = [("a", 0, 0, 2.0), ("a", 0, 1, 4.0), ("a", 1, 0, 3.0), ("b", 0, 0, 1.0)]
    losses = spark.createDataFrame(rows, "source string, tok_shard int, window_id long, loss double")
    got = {r.source: r for r in perplexity_rollup(losses).collect()}
    assert set(got) == {"a", "b", "TOTAL"}
    assert got["a"].windows == 3 and abs(got["a"].val_loss - 3.0) < 1e-9
    assert got["TOTAL"].windows == 4 and abs(got["TOTAL"].val_loss - 2.5) < 1e-9
    assert abs(got["b"].perplexity - round(math.e, 6)) < 1e-6


def test_epoch_steps_follow_the_global_batch(spark):
    from tessera.operators.evalplan import epoch_plan
    rows = [("s", 0, w, "train", [1]) for w in range(50)]
    win = spark.createDataFrame(rows, "source string, tok_shard int, window_id long, split string, ids array<int>")
    # 3 ranks share 16 windows as 5 each, 4 in whole micro-batches; the steps stay 50 // 16
    plan = epoch_plan(win, world_size=3, per_gpu_windows=5, micro_batch=2, global_windows=16).collect()
    assert {r.step for r in plan} == {0, 1, 2}
    assert len(plan) == 3 * 3 * 4
