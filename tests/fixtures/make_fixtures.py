"""Writes the tiny golden source folders under tests/fixtures/ (committed;
re-run only to regenerate). Layout mirrors the reference's source folders."""

from pathlib import Path

HERE = Path(__file__).parent
SENS = ["PR_1", "PR_2", "PR_3", "PR_4", "TEMP_1", "TEMP_2", "BRAKE_1", "SPEED_1",
        "SENSOR_1", "SENSOR_2", "SENSOR_3", "SENSOR_4", "SENSOR_5"]
HEAD = ";".join(["DATE", "HEURE", "PHASE", *SENS])

HEX_NORMAL = "0123456789abcdef0123456789abcdef"
HEX_SINGLE = "11111111111111111111111111111111"
HEX_DIR = "ffffffffffffffffffffffffffffffff"
HEX_IN_DIR_FILE = "bbbbbbbbbbbbbbbbbbbbbbbbbbbbbbbb"
HEX_SPACE = "cccccccccccccccccccccccccccccccc"
HEX_DIRTY = "dddddddddddddddddddddddddddddddd"
HEX_INV = "eeeeeeeeeeeeeeeeeeeeeeeeeeeeeeee"
HEX_CONST = "abcdefabcdefabcdefabcdefabcdefab"
HEX_NULLPH = "22222222222222222222222222222222"


def row(date, time, phase, pr1, rest="1"):
    vals = [pr1] + [rest] * 9 + ["0"] + [rest] * 2   # SENSOR_3 always 0
    return ";".join([date, time, phase, *vals])


def write(rel, lines):
    p = HERE / "timeseries" / rel
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text("\n".join([HEAD, *lines]) + "\n", encoding="utf-8")


def main():
    d = "01/02/2024"
    write(f"TimeSeries_20240201_080000_{HEX_NORMAL}.csv", [
        row(d, "08:00:00", "P1", "1"), row(d, "08:00:10", "P1", "2"),
        row(d, "08:00:20", "P2", "3"), row(d, "08:00:30", "P2", "4"),
        row(d, "08:00:40", "P3", "10")])
    write(f"TimeSeries_20240201_090000_{HEX_SINGLE}.csv", [row(d, "09:00:00", "P1", "5")])
    write("TimeSeries_20240201_093000_nothexatall.csv", [
        row(d, "09:30:00", "P1", "1"), row(d, "09:30:01", "P1", "2"),
        row(d, "09:30:02", "P1", "3")])
    write(f"{HEX_DIR}/TimeSeries_20240201_100000_{HEX_IN_DIR_FILE}.csv", [
        row(d, "10:00:00", "P1", "1"), row(d, "10:00:01", "P1", "2"),
        row(d, "10:00:02", "P1", "3")])
    write(f"Test Bench/TimeSeries_20240201_110000_{HEX_SPACE}.csv", [
        row(d, "11:00:00", "P1", "1"), row(d, "11:00:01", "P1", "2"),
        row(d, "11:00:02", "P1", "3")])
    write(f"TimeSeries_20240201_120000_{HEX_DIRTY}.csv", [
        row(d, "12:00:00", "P1", "2,5"), row(d, "12:00:01", "P1", ""),
        row(d, "12:00:02", "P1", "abc"), row(d, "12:00:03", "P1", "7"),
        row("2024-02-01", "12:00:04", "P1", "8"), row("", "12:00:05", "P1", "9")])
    write(f"TimeSeries_20240201_130000_{HEX_INV}.csv", [
        row(d, "13:00:00", "P1", "1"), row(d, "13:00:05", "P1", "2"),
        row(d, "13:00:03", "P1", "3"), row(d, "13:00:06", "P1", "4"),
        row(d, "13:00:06", "P1", "5")])
    write(f"TimeSeries_20240201_140000_{HEX_CONST}.csv", [
        ";".join([d, f"14:00:0{i}", "P1", str(i)] + ["0"] + [""] + ["1"] * 10)
        for i in range(4)])
    write(f"TimeSeries_20240201_150000_{HEX_NULLPH}.csv", [
        row(d, "15:00:00", "P1", "1"), row(d, "15:00:01", "", "2"),
        row(d, "15:00:02", "P2", "3"), row(d, "15:00:03", "P2", "4")])

    res = HERE / "results" / "results.csv"
    res.parent.mkdir(parents=True, exist_ok=True)
    res.write_text("\n".join([
        "SERIAL_NUMBER;PRODUCT_NUMBER;RESULT;TEST_STAND;TEST_DATE",
        f"S1;P1;G;B1;2024-01-01", f"S1;P1;W;B2;2024-01-02",
        f"S2;P2;W;B1;2024-01-01", f"S2;P2;G;B1;2024-01-02",
        f"S3;P1;G;B1;2024-01-01", f"S3;P1;G;B2;2024-01-02",
        f"S4;P3;W;B2;2024-01-01",
        f"S5;P1;;B1;2024-01-01", f"S6;P1; W;B1;2024-01-01",
        f"S7;P1;w;B1;2024-01-01", f"S8;P1;X;B1;2024-01-01",
        f"  S9 ; P4 ;G;B1;2024-01-01", f" S9;P4;G;B1;2024-01-02", f"S10 ;P4;W;B1;2024-01-01",
        f"{HEX_NORMAL};P1;W;B1;2024-01-01", f"{HEX_SINGLE};P2;G;B2;2024-01-01",
    ]) + "\n", encoding="utf-8")

    war = HERE / "warranty" / "warranty.csv"
    war.parent.mkdir(parents=True, exist_ok=True)
    war.write_text("SERIAL_NUMBER;CLAIM\nW1;a\n W2 ;b\nW3;c\n", encoding="utf-8")

    it = HERE / "items_dup" / "items.csv"
    it.parent.mkdir(parents=True, exist_ok=True)
    it.write_text("PRODUCT_NUMBER;GROUP;NATURE;MODEL;STATUS\n"
                  "P1;G2;N1;M1;active\nP1;G1;N9;M9;old\n P2 ; G3 ;N2;M2;active\nP3;G1;N3;M3;\n",
                  encoding="utf-8")
    it2 = HERE / "items_nostatus" / "items.csv"
    it2.parent.mkdir(parents=True, exist_ok=True)
    it2.write_text("PRODUCT_NUMBER;GROUP;NATURE;MODEL\nP1;G1;N1;M1\nP2;G2;N2;M2\n",
                   encoding="utf-8")


if __name__ == "__main__":
    main()
