"""Writers: batch outputs, the published layout and the table catalog."""
