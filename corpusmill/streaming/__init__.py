from corpusmill.streaming.render_stream import run_available_now, stream_samples

__all__ = ["run_available_now", "stream_samples"]
