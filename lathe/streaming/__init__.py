from lathe.streaming.pipeline import (  # noqa: F401
    model_batch_writer,
    rolling_counts,
    run_to_completion,
    scoring_batch_writer,
    table_stream,
)
