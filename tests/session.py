from tidemark.session import local_session

__all__ = ["local_session"]
