"""Memory of a worker that encodes pieces."""

import public_tokenizers
import pyarrow as pa

from catalith.llm import kernel, packing, pieces


def test_pieces_go_to_the_library_in_small_calls():
    encoder = pieces.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    library, calls = encoder.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return library.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    text = " ".join(f"w{i}" for i in range(9_000))
    ((_, _, ids, _),) = encoder.encode(pa.array([text]))
    assert sum(calls) > 8_000 and max(calls) <= 4_000
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_packing_task_lets_its_pieces_go(monkeypatch):
    class Task:
        def mapInArrow(self, run, schema):
            rows = run(iter([pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three", None])], names=["doc_id", "text"])]))
            first = next(rows)
            held = bool(kernel._caches["pieces"])
            return first, list(rows), held

    monkeypatch.setattr(kernel, "texts_of", lambda *columns: Task())
    first, rest, held = packing.cut_pieces(None, public_tokenizers.path("byte_bpe_50k.json"))
    assert first.num_rows == 2 and not rest and held
    assert not kernel._caches.get("pieces")
