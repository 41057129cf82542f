from revmart.streaming.landing_stream import start_landing_stream

__all__ = ["start_landing_stream"]
