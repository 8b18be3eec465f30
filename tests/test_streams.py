"""Streams into a store, and files' states in a stream."""

import random
import shutil

from test_ingest import deliver, store, values  # noqa: F401

from tarnlab.streaming import ingest
from tarnlab.warehouse.store import TRANSITIONS


def test_a_replayed_batch_changes_nothing(spark, store, tmp_path):  # noqa: F811
    folder = deliver(tmp_path / "in")
    checkpoint = f"{tmp_path}/checkpoint"
    ingest.stream_into(store, folder, checkpoint)
    version = store.version
    assert values(store) == [(0.5, 0)] and store.read("ingest_sighting").count() == 2 and store.read("ingest_batch").first().n_files == 2
    shutil.rmtree(f"{checkpoint}/commits")  # as if it had been killed before the stream noted that the batch is done
    ingest.stream_into(store, folder, checkpoint)
    assert store.version == version and values(store) == [(0.5, 0)]


def in_order(reports):
    """The steps of each file, its reports taken by number."""
    out = set()
    for h in {r[0] for r in reports}:
        old = None
        for _, seq, new in sorted({r for r in reports if r[0] == h}, key=lambda r: r[1]):
            legal = new == "seen" if old is None else new in TRANSITIONS.get(old, ())
            out.add((h, seq, old, new, legal))
            old = new if legal else old
    return out


def test_states_in_any_order(spark, tmp_path):
    rng = random.Random(4)
    names = [*TRANSITIONS, "archived", "failed"]
    reports = []
    for k in range(30):
        chain, state = ["seen"], "seen"
        while state in TRANSITIONS and len(chain) < 9:
            state = rng.choice(TRANSITIONS[state])
            chain += [rng.choice(names), state] if rng.random() < 0.3 else [state]
        reports += [(f"h{k}", seq, s) for seq, s in enumerate(chain)]
    sent = reports + rng.sample(reports, 40)
    rng.shuffle(sent)
    source, got = tmp_path / "reports", []
    schema = "hash string, seq long, state string"
    for part in range(3):  # the stream ends and starts again between the parts
        spark.createDataFrame(sent[part::3], schema).coalesce(1).write.mode("append").parquet(f"file://{source}")
        steps = ingest.file_states(spark.readStream.schema(schema).parquet(f"file://{source}"))
        take = lambda df, _: got.extend(tuple(r) for r in df.collect())
        steps.writeStream.trigger(availableNow=True).option("checkpointLocation", f"file://{tmp_path}/state").foreachBatch(take).start().awaitTermination()
    assert len(got) == len(set(got)) and set(got) == in_order(reports)
    assert any(not r[4] for r in got)
