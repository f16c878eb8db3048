"""File system questions, asked through Hadoop so they work on any shared storage."""

from __future__ import annotations


def _located(spark, path):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark, path):
    fs, hadoop_path = _located(spark, path)
    return fs.exists(hadoop_path)


def make_folder(spark, path):
    fs, hadoop_path = _located(spark, path)
    fs.mkdirs(hadoop_path)


def move_folder(spark, path, to):
    fs, hadoop_path = _located(spark, path)
    if not fs.rename(hadoop_path, _located(spark, to)[1]):
        raise OSError(f"{path} cannot be moved to {to}")


def age_parts(spark, path):
    """Give the parts of a written folder ages in the order of their numbers, a second apart, the last
    one the newest. False where the file system does not keep them.
    """
    fs, hadoop_path = _located(spark, path)

    def parts():
        found = [entry for entry in fs.listStatus(hadoop_path) if entry.getPath().getName().startswith("part-")]
        return sorted(found, key=lambda entry: entry.getPath().getName())

    written = parts()
    newest_ms = max((entry.getModificationTime() for entry in written), default=0)
    for back, entry in enumerate(reversed(written)):
        fs.setTimes(entry.getPath(), newest_ms // 1000 * 1000 - back * 1000, -1)
    ages = [entry.getModificationTime() for entry in parts()]
    return all(a < b for a, b in zip(ages, ages[1:]))


def publish_parts(spark, waiting, folder, together):
    """Move the next ``together`` parts of a written folder to another; False if none is left.

    A part keeps its number, and numbers without a file count too.
    """
    fs, waiting_path = _located(spark, waiting)
    if not fs.exists(waiting_path):
        return False
    names = [entry.getPath().getName() for entry in fs.listStatus(waiting_path)]
    groups = {name: int(name.split("-")[1]) // together for name in names if name.startswith("part-")}
    for name, group in groups.items():
        if group == min(groups.values()):
            if not fs.rename(_located(spark, f"{waiting}/{name}")[1], _located(spark, f"{folder}/{name}")[1]):
                raise OSError(f"{waiting}/{name} cannot be moved to {folder}")
    return bool(groups)


def newest(spark, path, key, below=None):
    """The largest number of a finished folder ``key=N`` in ``path``, or None: one listing, then one call
    for each unfinished folder in front of it and one for itself.
    """
    if not path_exists(spark, path):
        return None
    fs, hadoop_path = _located(spark, path)
    names = [entry.getPath().getName() for entry in fs.listStatus(hadoop_path)]
    found = sorted((int(name[len(key) + 1:]) for name in names if name.startswith(f"{key}=")), reverse=True)
    return next((n for n in found if (below is None or n < below)
                 and path_exists(spark, f"{path}/{key}={n}/_SUCCESS")), None)


def newest_part(spark, path, key):
    """The largest number of the partition folders ``key=N`` in ``path``, or None."""
    fs, hadoop_path = _located(spark, path)
    names = [entry.getPath().getName() for entry in fs.listStatus(hadoop_path)]
    return max((int(name[len(key) + 1:]) for name in names if name.startswith(f"{key}=")), default=None)


def numbered(spark, path, key, above=None, upto=None):
    """The numbers of the finished folders ``key=N`` in ``path``, sorted; lists one level only.

    Only numbers over ``above`` and not over ``upto`` are asked about, one call each.
    """
    if not path_exists(spark, path):
        return []
    fs, hadoop_path = _located(spark, path)
    names = [entry.getPath().getName() for entry in fs.listStatus(hadoop_path)]
    found = (int(name[len(key) + 1:]) for name in names if name.startswith(f"{key}="))
    wanted = (n for n in found if (above is None or n > above) and (upto is None or n <= upto))
    return sorted(n for n in wanted if path_exists(spark, f"{path}/{key}={n}/_SUCCESS"))
