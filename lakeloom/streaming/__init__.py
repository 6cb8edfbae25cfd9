from lakeloom.streaming.silver import stream_silver

__all__ = ["stream_silver"]
