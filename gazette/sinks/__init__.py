"""Writers. Every batch write goes to its own folder, so a replay overwrites itself."""
