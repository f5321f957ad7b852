"""Writers: text files, console, epoch tables, foreach objects."""
