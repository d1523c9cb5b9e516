"""Column names and types of the hourly table."""

# Header of the raw hourly CSV (four names end in a space).
RENAMES = {
    "Date": "date",
    "Time (Local)": "hour",
    "Eyeballs ": "eyeballs",
    "Zeroes ": "zeroes",
    "Completed Trips ": "completed_trips",
    "Requests ": "requests",
    "Unique Drivers": "drivers",
}

# Fixed value: spelling of the sparse date labels, two-digit day and year.
LABEL_FORMAT = "dd-MMM-yy"

COUNTERS = ["eyeballs", "zeroes", "completed_trips", "requests", "drivers"]
HOURLY = ["ts", "date", "hour", *COUNTERS]

# Where a CSV row stands: file, start of the split, number within the scan.
PLACE_IN_SOURCE = ["src_file", "src_start", "src_seq"]
# Line of a CSV row with more or fewer fields than the header, else null.
LINE = "src_line"
# Number of a row in its source; breaks ties between equal timestamps.
ROW_NO = "row_no"
