from pyarrow import fs

from samples.tiles import shown_tiles


def names(root: str) -> set[str]:
    found, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
    files = found.get_file_info(fs.FileSelector(base, recursive=True))
    return {f.base_name for f in files if f.extension == "png"}


def test_shown_tiles_lie_in_three_folders(spark):
    training, testing, flat = shown_tiles(spark, "/root/testdata/sf0.001")
    assert len({training, testing, flat}) == 3
    assert names(training) and names(testing) and not names(training) & names(testing)
    assert names(training) | names(testing) == names(flat)
