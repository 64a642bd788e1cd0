"""Writers whose bytes are part of the contract. Rows are formatted as columns; only single files pass through the driver, row by row."""
