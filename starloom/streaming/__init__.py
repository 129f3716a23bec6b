from starloom.streaming.files import load_new_files
from starloom.streaming.windows import close_windows

__all__ = ["close_windows", "load_new_files"]
