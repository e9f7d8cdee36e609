"""What a worker of byte-level BPE holds."""

from examloom.llm import bpe


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_pieces_in_memory_are_bounded(monkeypatch):
    """Pieces that come again and again stay known while others come and go."""
    monkeypatch.setattr(bpe, "CACHE_PIECES", 40)
    codec, often = bpe.Codec(*vocabulary()), " zzqqxxyy often9zz"
    plain = codec.encode([often])[0]
    asked, contract = [], codec._contract
    monkeypatch.setattr(codec, "_contract", lambda pieces, sql: asked.extend(pieces) or contract(pieces, sql))
    for i in range(20):
        text = " ".join(f"qx{chr(97 + i)}zk{chr(97 + j)}vv" for j in range(15))
        ids = codec.encode([text + often])[0]
        assert ids.endswith(plain) and codec.decode([ids]) == [(text + often).encode()]
        assert len(codec.cache) + len(codec.older) < 2 * (40 + 25)
    assert not any(b"zzqqxxyy" in piece for piece in asked)


def test_byte_bpe_gets_few_rows_at_once(spark, monkeypatch):
    seen, staged = [], bpe.staged
    monkeypatch.setattr(bpe, "staged", lambda df, name: seen.append(
        int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))) or staged(df, name))
    out = bpe.training_rows(spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string"), *vocabulary()).collect()
    assert seen == [bpe.BATCH_ROWS] and len(out) == 20 and all(r["exact"] for r in out)
