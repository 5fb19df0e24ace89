"""Small files of a shared folder, read and written by tasks and by data sources without a session."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs


class Folder:
    """A folder of any file system that pyarrow knows, by path or URI."""

    def __init__(self, location: str):
        plain = location.removeprefix("file://") if location.startswith("file:///") else location.removeprefix("file:")
        self.files, self.path = (fs.LocalFileSystem(), plain) if "://" not in plain else fs.FileSystem.from_uri(location)

    def names(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(self.path, allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file)

    def read(self, name: str) -> str:
        with self.files.open_input_stream(f"{self.path}/{name}") as file:
            return file.read().decode()

    def write(self, name: str, text: str) -> None:
        """Write a whole file, so that readers see all of it or none."""
        with self.begin(name) as file:
            file.write(text.encode())
        self.show(name)

    def begin(self, name: str) -> pa.NativeFile:
        """A file to write to, which readers see after ``show``."""
        self.files.create_dir(self.path, recursive=True)
        return self.files.open_output_stream(f"{self.path}/.{name}.part", buffer_size=1 << 16)

    def show(self, name: str) -> None:
        self.files.move(f"{self.path}/.{name}.part", f"{self.path}/{name}")


def open_folder(location: str) -> Folder:
    return Folder(location.rstrip("/"))
