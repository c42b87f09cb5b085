from pricelens.streaming.scoring import listing_stream, score_stream  # noqa: F401
